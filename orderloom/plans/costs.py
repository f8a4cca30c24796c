"""Usage-cost queries: attribution, daily spend, weekly pivots and cross-source totals."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.columns import MISSING_CELL, as_day, label_or, short_service, short_sku, week_of
from orderloom.operators.latest import latest_revision
from orderloom.operators.pivot import weekly_pivot
from orderloom.operators.pricing import price_totals, price_usage

# Fixed value: label of usage without a unit.
NO_UNIT = "(none)"


def in_trailing_window(usage: DataFrame, days: int, as_of: str | date | None = None) -> DataFrame:
    """Usage dated at most ``days`` days before ``as_of`` (default: today)."""
    if days < 1:
        raise ValueError("days must be at least 1")
    end = F.lit(as_day(as_of)) if as_of else F.current_date()
    return usage.filter(F.col("usage_date") >= F.date_sub(end, days))


def attributable(usage: DataFrame) -> DataFrame:
    """Usage that belongs to a job or a pipeline."""
    owner = F.coalesce(F.col("usage_metadata.job_id"), F.col("usage_metadata.dlt_pipeline_id"))
    return usage.filter(owner.isNotNull())


def with_pipeline_names(usage: DataFrame, pipelines: DataFrame) -> DataFrame:
    """Left join to the last known name of each pipeline; one name per pipeline, so nothing fans out."""
    names = latest_revision(pipelines).withColumnRenamed("name", "pipeline_name")
    return usage.join(names, "pipeline_id", "left")


def spend_by_entity(
    usage: DataFrame, list_prices: DataFrame, pipelines: DataFrame, days: int = 30, as_of: str | date | None = None
) -> DataFrame:
    """Quantity, USD and active days per job or pipeline and unit, most expensive first.

    Usage is summed per owner, unit and day before the name join: the many rows without a pipeline
    id shrink to one per job and day instead of meeting under one NULL join key.
    """
    priced = price_usage(attributable(in_trailing_window(usage, days, as_of)), list_prices)
    per_day = priced.groupBy(
        F.col("usage_metadata.job_name").alias("job_name"),
        F.col("usage_metadata.dlt_pipeline_id").alias("pipeline_id"),
        "usage_unit",
        "usage_date",
    ).agg(
        F.sum("usage_quantity").alias("quantity"),
        F.sum(F.col("usage_quantity") * F.col("effective_price")).alias("usd"),
    )
    entity = F.coalesce(F.col("job_name"), F.col("pipeline_name"), F.lit("(unnamed)"))
    kind = F.when(F.col("pipeline_id").isNotNull(), F.lit("pipeline")).otherwise(F.lit("job"))
    return (
        with_pipeline_names(per_day, pipelines)
        .groupBy(entity.alias("entity"), kind.alias("kind"), "usage_unit")
        .agg(
            F.sum("quantity").alias("quantity"),
            F.sum("usd").alias("usd"),
            F.countDistinct("usage_date").alias("active_days"),
        )
        .orderBy(F.col("usd").desc())
    )


def spend_by_day_sku(
    usage: DataFrame, list_prices: DataFrame, days: int = 30, as_of: str | date | None = None
) -> DataFrame:
    """Quantity, USD and unpriced records per day, SKU and unit; unrounded, newest day first."""
    priced = price_usage(in_trailing_window(usage, days, as_of), list_prices)
    return (
        priced.groupBy("usage_date", "sku_name", "usage_unit")
        .agg(
            F.sum("usage_quantity").alias("total_quantity"),
            F.sum(F.col("usage_quantity") * F.col("effective_price")).alias("usd"),
            F.count_if(~F.col("priced")).alias("unpriced_records"),
        )
        .orderBy(F.col("usage_date").desc(), F.col("usd").desc())
    )


def unpriced_skus(daily: DataFrame) -> DataFrame:
    """SKUs with usage that no price version covers: their USD is understated."""
    return daily.filter(F.col("unpriced_records") > 0).select("sku_name").distinct()


def usage_report_rows(daily: DataFrame) -> DataFrame:
    """Daily spend with week, short SKU and a printable unit."""
    return daily.select(
        "usage_date",
        "sku_name",
        "total_quantity",
        F.coalesce(F.col("usage_unit"), F.lit(NO_UNIT)).alias("usage_unit"),
        "usd",
        week_of(F.col("usage_date")).alias("week"),
        short_sku(F.col("sku_name")).alias("sku_short"),
    )


def job_usage_on(usage: DataFrame, day: str | date) -> DataFrame:
    return usage.filter((F.col("usage_date") == F.lit(as_day(day))) & F.col("usage_metadata.job_id").isNotNull())


def job_costs_on_date(
    usage: DataFrame, list_prices: DataFrame, day: str | date, price_join: str = "interval"
) -> DataFrame:
    """Units, runs and estimated cost per job and SKU on one day, most expensive first.

    ``"interval"`` prices each row by the version in force. ``"equi"`` matches every version of the
    (SKU, cloud), counting a row once per version as a join without date scope does; the versions are
    summed beforehand, so the usage itself never fans out.
    """
    if price_join not in ("interval", "equi"):
        raise ValueError(f"unknown price join {price_join}")
    wanted = job_usage_on(usage, day)
    keys = ["job_id", "job_name", "sku_name", "cloud"]
    named = [F.col("usage_metadata.job_id").alias("job_id"), F.col("usage_metadata.job_name").alias("job_name")]
    run = F.col("usage_metadata.job_run_id").alias("job_run_id")
    if price_join == "interval":
        priced = price_usage(wanted, list_prices)
        cost = F.col("usage_quantity") * F.col("effective_price")
        lines = priced.select(*named, "sku_name", "cloud", run, F.col("usage_quantity").alias("dbu"), cost.alias("cost"))
    else:
        per_run = wanted.groupBy(*named, "sku_name", "cloud", run).agg(F.sum("usage_quantity").alias("quantity"))
        matched = per_run.join(price_totals(list_prices), ["sku_name", "cloud"], "left")
        copies = F.coalesce(F.col("versions"), F.lit(1))
        lines = matched.select(
            *keys,
            "job_run_id",
            (F.col("quantity") * copies).alias("dbu"),
            (F.col("quantity") * F.col("price_sum")).alias("cost"),
        )
    return (
        lines.groupBy(*keys)
        .agg(
            F.sum("dbu").alias("total_dbu"),
            F.countDistinct("job_run_id").alias("num_runs"),
            F.round(F.sum("cost"), 2).alias("estimated_cost_usd"),
        )
        .orderBy(F.col("estimated_cost_usd").desc())
    )


def job_cost_rows(costs: DataFrame) -> DataFrame:
    """Display form: defaults for missing labels and numbers."""
    return costs.select(
        F.coalesce(F.col("job_id").cast("string"), F.lit("N/A")).alias("job_id"),
        label_or(F.col("job_name"), "Unnamed").alias("job_name"),
        label_or(F.col("sku_name"), "Unnamed").alias("sku_name"),
        F.coalesce(F.col("num_runs"), F.lit(0)).alias("num_runs"),
        F.coalesce(F.col("total_dbu"), F.lit(0)).alias("total_dbu"),
        F.coalesce(F.col("estimated_cost_usd"), F.lit(0)).alias("estimated_cost_usd"),
    )


def job_cost_summary(costs: DataFrame) -> DataFrame:
    """Distinct jobs, units and cost over the table's (rounded) rows."""
    return costs.agg(
        F.countDistinct("job_id").alias("total_jobs"),
        F.coalesce(F.sum("total_dbu"), F.lit(0)).alias("total_dbu"),
        F.coalesce(F.sum("estimated_cost_usd"), F.lit(0)).alias("total_cost"),
    )


def cloud_weekly_pivot(cloud: DataFrame) -> DataFrame:
    """Weeks by service in USD; weeks holding estimated days are marked."""
    short = cloud.withColumn("short", short_service(F.col("service")))
    return weekly_pivot(short, "short", "blended_cost_usd", flag="estimated")


def sku_weekly_pivot(report_rows: DataFrame) -> DataFrame:
    """Weeks by short SKU in USD."""
    return weekly_pivot(report_rows, "sku_short", "usd")


def sku_totals(report_rows: DataFrame) -> DataFrame:
    """Quantity, unit and USD per SKU; a SKU without any price costs 0."""
    return (
        report_rows.groupBy(F.col("sku_name").alias("SKU"), F.col("usage_unit").alias("Unit"))
        .agg(
            F.coalesce(F.sum("total_quantity"), F.lit(0)).alias("Quantity"),
            F.coalesce(F.sum("usd"), F.lit(0)).alias("USD"),
        )
        .select("SKU", "Quantity", "Unit", "USD")
    )


def spend_by_sku(report_rows: DataFrame) -> DataFrame:
    """The SKU totals, most expensive first."""
    return sku_totals(report_rows).orderBy(F.col("USD").desc())


def spend_by_service(cloud: DataFrame) -> DataFrame:
    return cloud.groupBy(F.col("service").alias("Service")).agg(
        F.coalesce(F.sum("blended_cost_usd"), F.lit(0)).alias("USD")
    )


def combined_totals(
    cloud: DataFrame | None, report_rows: DataFrame | None, cloud_label: str, platform_label: str
) -> DataFrame | None:
    """One row per service and SKU across both sources, positive cost only.

    The cloud side has no usage quantity: NULL quantity and a dash for the unit. A SKU without any
    price has no cost and is not listed here; ``unpriced_skus`` names it.
    """
    quantity, usd = F.col("Quantity").cast("double"), F.col("USD").cast("double")
    parts = []
    if cloud is not None:
        parts.append(
            spend_by_service(cloud).select(
                F.lit(cloud_label).alias("Cloud"),
                "Service",
                F.lit(None).cast("double").alias("Quantity"),
                F.lit(MISSING_CELL).alias("Unit"),
                usd.alias("USD"),
            )
        )
    if report_rows is not None:
        parts.append(
            sku_totals(report_rows).select(
                F.lit(platform_label).alias("Cloud"),
                F.col("SKU").alias("Service"),
                quantity.alias("Quantity"),
                "Unit",
                usd.alias("USD"),
            )
        )
    if not parts:
        return None
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return positive(both, "USD").orderBy(F.col("Cloud").asc(), F.col("USD").desc())


def positive(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) > 0)


def headline(combined: DataFrame) -> DataFrame:
    """USD per source, and for all of them in the row with a NULL source."""
    return combined.rollup("Cloud").agg(F.sum("USD").alias("USD"))


def attributed_share(entity: DataFrame, daily: DataFrame) -> DataFrame:
    """Whole-percent share of the spend that belongs to jobs and pipelines; ``?`` without any spend."""
    attributed = entity.agg(F.sum("usd").cast("double").alias("part")).select("part").scalar()
    whole = F.col("whole")
    percent = F.bround(100 * F.coalesce(F.col("part"), F.lit(0.0)) / F.nullif(whole, F.lit(0.0)))
    return (
        daily.agg(F.sum("usd").cast("double").alias("whole"))
        .withColumn("part", attributed)
        .select(F.coalesce(percent.cast("bigint").cast("string"), F.lit("?")).alias("attributed_pct"))
    )


def any_estimated(cloud: DataFrame) -> DataFrame:
    return cloud.agg(F.coalesce(F.bool_or("estimated"), F.lit(False)).alias("any_estimated"))


def daily_cloud_detail(cloud: DataFrame) -> DataFrame:
    """Non-zero cloud cost per day and service, in report columns."""
    return positive(cloud, "blended_cost_usd").select(
        F.col("date").alias("Date"),
        F.col("service").alias("Service"),
        F.col("blended_cost_usd").alias("USD"),
        F.col("estimated").alias("Estimated"),
    )


def daily_usage_detail(report_rows: DataFrame) -> DataFrame:
    """Daily spend per SKU, in report columns."""
    return report_rows.select(
        F.col("usage_date").alias("Date"),
        F.col("sku_name").alias("SKU"),
        F.col("total_quantity").alias("Quantity"),
        F.col("usage_unit").alias("Unit"),
        F.col("usd").alias("USD"),
    )
