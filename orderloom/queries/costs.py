"""Usage-cost queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.functions.columns import money, short_service, short_sku
from orderloom.operators.asof import price_usage_by_sweep
from orderloom.operators.latest import latest_revision
from orderloom.operators.pivot import weekly_cells, weekly_pivot
from orderloom.operators.pricing import price_usage
from orderloom.operators.report import format_report
from orderloom.plans import costs as c
from orderloom.queries import tables as t
from orderloom.queries.registry import query
from orderloom.sources.costfeed import flatten_cost_json

WINDOW = {"days": 21, "as_of": "2024-01-31"}
DAY = "2024-01-16"
CLOUD, PLATFORM = "Cloud", "Platform"


def _exact(column: Column | str, places: int = 4) -> Column:
    """Decimal amounts as doubles with a fixed number of places, for comparison."""
    return F.round(column, places).cast("double")


def _entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.spend_by_entity(
        t.usage(spark, sf_dir), t.list_prices(spark, sf_dir), t.pipelines(spark, sf_dir), **WINDOW
    )


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.spend_by_day_sku(t.usage(spark, sf_dir), t.list_prices(spark, sf_dir), **WINDOW)


def _report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.usage_report_rows(_daily(spark, sf_dir))


def _cloud(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_cost_json(t.cost_documents(spark, sf_dir))


_META = "job_id, job_name, job_run_id, dlt_pipeline_id"
_USAGE_OUT = (
    "usage_date, usage_end_time, sku_name, cloud, CAST(usage_quantity AS DOUBLE) AS usage_quantity,"
    f" usage_unit, {_META}"
)


def _flat(usage: DataFrame) -> DataFrame:
    return usage.select(
        "usage_date",
        "usage_end_time",
        "sku_name",
        "cloud",
        F.col("usage_quantity").cast("double").alias("usage_quantity"),
        "usage_unit",
        "usage_metadata.job_id",
        "usage_metadata.job_name",
        "usage_metadata.job_run_id",
        "usage_metadata.dlt_pipeline_id",
    )


@query(t.sql(f"SELECT {_USAGE_OUT} FROM usage WHERE usage_date >= DATE '2024-01-31' - INTERVAL 21 DAY", "usage"))
def usage_in_trailing_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(c.in_trailing_window(t.usage(spark, sf_dir), **WINDOW))


@query(t.sql(f"SELECT {_USAGE_OUT} FROM usage WHERE COALESCE(job_id, dlt_pipeline_id) IS NOT NULL", "usage"))
def attributable_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(c.attributable(t.usage(spark, sf_dir)))


@query(t.sql(f"SELECT {_USAGE_OUT} FROM usage WHERE usage_date = '2024-01-16' AND job_id IS NOT NULL", "usage"))
def job_usage_on_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(c.job_usage_on(t.usage(spark, sf_dir), DAY))


@query(
    t.sql(
        "SELECT usage_end_time, sku_name, CAST(usage_quantity AS DOUBLE) AS usage_quantity,"
        " CAST(effective_price AS DOUBLE) AS effective_price, priced FROM priced",
        "priced",
    )
)
def usage_priced_by_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_usage(t.usage(spark, sf_dir), t.list_prices(spark, sf_dir)).select(
        "usage_end_time",
        "sku_name",
        F.col("usage_quantity").cast("double").alias("usage_quantity"),
        F.col("effective_price").cast("double").alias("effective_price"),
        "priced",
    )


def _prices_out(priced: DataFrame) -> DataFrame:
    return priced.select(
        "usage_end_time",
        "sku_name",
        F.col("usage_quantity").cast("double").alias("usage_quantity"),
        F.col("effective_price").cast("double").alias("effective_price"),
        "priced",
    )


@query(
    t.sql(
        "SELECT usage_end_time, sku_name, CAST(usage_quantity AS DOUBLE) AS usage_quantity,"
        " CAST(effective_price AS DOUBLE) AS effective_price, priced FROM priced",
        "priced",
    )
)
def usage_priced_by_day_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same prices from a sweep over each SKU's days."""
    return _prices_out(price_usage_by_sweep(t.usage(spark, sf_dir), t.list_prices(spark, sf_dir)))


def many_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A price version for every minute in which a SKU was used by an even user; every seventh ends after a minute."""
    started = t.usage(spark, sf_dir).filter("CAST(usage_metadata.job_id AS BIGINT) % 2 = 0")
    starts = started.select("sku_name", "cloud", F.date_trunc("minute", "usage_end_time").alias("begin")).distinct()
    following = F.lead("begin").over(Window.partitionBy("sku_name").orderBy("begin"))
    minute = F.minute("begin")
    brief = F.col("begin") + F.expr("INTERVAL 1 MINUTE")
    cents = (minute + 1).cast("decimal(18,6)")
    return starts.withColumn("following", following).select(
        "sku_name",
        "cloud",
        F.col("begin").cast("timestamp_ntz").alias("price_start_time"),
        F.when(minute % 7 == 0, brief).otherwise(F.col("following")).cast("timestamp_ntz").alias("price_end_time"),
        F.struct(
            (cents / 100).cast("decimal(18,6)").alias("default"),
            F.struct((cents / 200).cast("decimal(18,6)").alias("default")).alias("effective_list"),
        ).alias("pricing"),
    )


_MANY_VERSIONS = t.sql(
    "SELECT u.usage_end_time, u.sku_name, CAST(u.usage_quantity AS DOUBLE) AS usage_quantity,"
    " CASE WHEN v.until IS NULL OR u.usage_end_time < v.until THEN v.price END AS effective_price,"
    " COALESCE(v.begin IS NOT NULL AND (v.until IS NULL OR u.usage_end_time < v.until), FALSE) AS priced"
    " FROM usage u ASOF LEFT JOIN (SELECT sku_name, begin,"
    " CASE WHEN minute(begin) % 7 = 0 THEN begin + INTERVAL 1 MINUTE"
    " ELSE lead(begin) OVER (PARTITION BY sku_name ORDER BY begin) END AS until,"
    " CAST(CAST((minute(begin) + 1) / 200.0 AS DECIMAL(18,6)) AS DOUBLE) AS price FROM (SELECT DISTINCT sku_name,"
    " date_trunc('minute', usage_end_time) AS begin FROM usage WHERE CAST(job_id AS BIGINT) % 2 = 0)) v"
    " ON u.sku_name = v.sku_name AND u.usage_end_time >= v.begin",
    "usage",
)


@query(_MANY_VERSIONS)
def usage_priced_by_many_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thousands of price versions a SKU: the sweep compares each usage row with one of them."""
    return _prices_out(price_usage_by_sweep(t.usage(spark, sf_dir), many_versions(spark, sf_dir)))


@query(t.sql("SELECT pipeline_id, name FROM pipe_names", "pipe_names"))
def latest_revision_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_revision(t.pipelines(spark, sf_dir))


@query(
    t.sql(
        "SELECT u.usage_end_time, u.dlt_pipeline_id AS pipeline_id, n.name AS pipeline_name FROM usage u"
        " LEFT JOIN pipe_names n ON n.pipeline_id = u.dlt_pipeline_id"
        " WHERE u.job_id IS NOT NULL OR u.dlt_pipeline_id IS NOT NULL",
        "usage",
        "pipe_names",
    )
)
def usage_with_owner_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    owned = c.attributable(t.usage(spark, sf_dir))
    keyed = owned.select("usage_end_time", F.col("usage_metadata.dlt_pipeline_id").alias("pipeline_id"))
    return c.with_pipeline_names(keyed, t.pipelines(spark, sf_dir))


@query(
    t.sql(
        "SELECT entity, kind, usage_unit, CAST(quantity AS DOUBLE) AS quantity,"
        " CAST(ROUND(usd, 4) AS DOUBLE) AS usd, active_days FROM entity ORDER BY usd DESC",
        "entity",
    )
)
def spend_by_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entity(spark, sf_dir).select(
        "entity", "kind", "usage_unit", _exact("quantity").alias("quantity"), _exact("usd").alias("usd"), "active_days"
    )


@query(
    t.sql(
        "SELECT usage_date, sku_name, usage_unit, CAST(total_quantity AS DOUBLE) AS total_quantity,"
        " CAST(ROUND(usd, 4) AS DOUBLE) AS usd, unpriced_records FROM daily ORDER BY usage_date DESC, usd DESC",
        "daily",
    )
)
def spend_by_day_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir).select(
        "usage_date",
        "sku_name",
        "usage_unit",
        _exact("total_quantity").alias("total_quantity"),
        _exact("usd").alias("usd"),
        "unpriced_records",
    )


@query(t.sql("SELECT DISTINCT sku_name FROM daily WHERE unpriced_records > 0", "daily"))
def unpriced_skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.unpriced_skus(_daily(spark, sf_dir))


def _job_costs_sql(join: str, price: str) -> str:
    return (
        "SELECT u.job_id, u.job_name, u.sku_name, u.cloud, SUM(u.usage_quantity) AS total_dbu,"
        f" COUNT(DISTINCT u.job_run_id) AS num_runs, ROUND(SUM(u.usage_quantity * p.{price}), 2) AS estimated_cost_usd"
        f" FROM usage u LEFT JOIN prices p ON u.sku_name = p.sku_name AND {join}"
        " WHERE u.usage_date = '2024-01-16' AND u.job_id IS NOT NULL GROUP BY 1, 2, 3, 4"
    )


_EQUI = _job_costs_sql("u.cloud = p.cloud", "list_price")
_INTERVAL = _job_costs_sql(
    "p.price_start_time <= u.usage_end_time AND COALESCE(p.price_end_time, TIMESTAMP 'infinity') > u.usage_end_time",
    "effective_price",
)
_JOB_OUT = (
    "SELECT job_id, job_name, sku_name, cloud, CAST(total_dbu AS DOUBLE) AS total_dbu, num_runs,"
    " CAST(estimated_cost_usd AS DOUBLE) AS estimated_cost_usd"
)


def _job_costs(spark: SparkSession, sf_dir: str, price_join: str) -> DataFrame:
    return c.job_costs_on_date(t.usage(spark, sf_dir), t.list_prices(spark, sf_dir), DAY, price_join)


def _job_columns(costs: DataFrame) -> DataFrame:
    return costs.select(
        "job_id",
        "job_name",
        "sku_name",
        "cloud",
        _exact("total_dbu").alias("total_dbu"),
        "num_runs",
        _exact("estimated_cost_usd", 2).alias("estimated_cost_usd"),
    )


@query(t.sql(f"{_JOB_OUT} FROM ({_INTERVAL})", "usage", "prices"))
def job_costs_by_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _job_columns(_job_costs(spark, sf_dir, "interval"))


@query(t.sql(f"{_JOB_OUT} FROM ({_EQUI})", "usage", "prices"))
def job_costs_by_sku_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every price version of the SKU counts, as with a join that has no date scope."""
    return _job_columns(_job_costs(spark, sf_dir, "equi"))


@query(
    t.sql(
        "SELECT COALESCE(job_id, 'N/A') AS job_id, COALESCE(NULLIF(job_name, ''), 'Unnamed') AS job_name,"
        " COALESCE(NULLIF(sku_name, ''), 'Unnamed') AS sku_name, num_runs,"
        " CAST(COALESCE(total_dbu, 0) AS DOUBLE) AS total_dbu,"
        f" CAST(COALESCE(estimated_cost_usd, 0) AS DOUBLE) AS estimated_cost_usd FROM ({_INTERVAL})",
        "usage",
        "prices",
    )
)
def job_cost_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = c.job_cost_rows(_job_costs(spark, sf_dir, "interval"))
    return rows.withColumns({name: _exact(name) for name in ("total_dbu", "estimated_cost_usd")})


@query(
    t.sql(
        "SELECT COUNT(DISTINCT job_id) AS total_jobs, CAST(SUM(total_dbu) AS DOUBLE) AS total_dbu,"
        f" CAST(SUM(COALESCE(estimated_cost_usd, 0)) AS DOUBLE) AS total_cost FROM ({_INTERVAL})",
        "usage",
        "prices",
    )
)
def job_cost_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = c.job_cost_summary(_job_costs(spark, sf_dir, "interval"))
    return summary.select(
        "total_jobs", _exact("total_dbu").alias("total_dbu"), _exact("total_cost", 2).alias("total_cost")
    )


_SHORT = "regexp_replace(service, '^(Amazon|AWS)\\s+', '')"


def _pivot_sql(label: str, value: str, source: str, labels: list[str], places: int, flag: str) -> str:
    cells = ", ".join(
        f"CAST(ROUND(SUM(CASE WHEN label = '{name}' THEN value ELSE 0 END), {places}) AS DOUBLE) AS \"{name}\""
        for name in labels
    )
    kept = ", ".join(f"'{name}'" for name in labels)
    return t.sql(
        f"SELECT week || CASE WHEN bool_or(flag) THEN '*' ELSE '' END AS \"Week\", {cells},"
        f" CAST(ROUND(SUM(CASE WHEN label IN ({kept}) THEN value ELSE 0 END), {places}) AS DOUBLE) AS \"Total\""
        f" FROM (SELECT week, {label} AS label, COALESCE({value}, 0) AS value, {flag} AS flag FROM {source}) GROUP BY week",
        source,
    )


def _rounded(wide: DataFrame, places: int) -> DataFrame:
    return wide.select("Week", *[_exact(F.col(f"`{n}`"), places).alias(n) for n in wide.columns if n != "Week"])


@query(
    _pivot_sql(
        _SHORT, "blended_cost_usd", "cloud_cost", ["Flag AF", "Flag AO", "Flag NF", "Flag RF", "Flag RO"], 2, "estimated"
    )
)
def cloud_weekly_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(c.cloud_weekly_pivot(_cloud(spark, sf_dir)), 2)


@query(
    _pivot_sql(
        "sku_short",
        "usd",
        "rows_of_daily",
        ["CLICK_COMPUTE", "ERROR_COMPUTE", "PURCHASE_COMPUTE", "VIEW_COMPUTE"],
        4,
        "FALSE",
    )
)
def sku_weekly_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(c.sku_weekly_pivot(_report_rows(spark, sf_dir)), 4)


@query(
    t.sql(
        f"SELECT week, {_SHORT} AS label, ROUND(SUM(blended_cost_usd), 2) AS amount, bool_or(estimated) AS flagged"
        " FROM cloud_cost GROUP BY 1, 2",
        "cloud_cost",
    )
)
def cloud_weekly_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pivot in long form."""
    short = _cloud(spark, sf_dir).withColumn("short", short_service(F.col("service")))
    return weekly_cells(short, "short", "blended_cost_usd", "estimated").withColumn("amount", F.round("amount", 2))


@query(
    t.sql(
        "SELECT week, label, CAST(ROUND(amount, 4) AS DOUBLE) AS amount, CAST(ROUND(total, 4) AS DOUBLE) AS total FROM ("
        "SELECT week, sku_short AS label, COALESCE(SUM(usd), 0) AS amount,"
        " SUM(COALESCE(SUM(usd), 0)) OVER (PARTITION BY week) AS total FROM rows_of_daily GROUP BY 1, 2)",
        "rows_of_daily",
    )
)
def sku_weekly_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SKU pivot in long form, each cell with its week's total."""
    cells = weekly_cells(_report_rows(spark, sf_dir), "sku_short", "usd")
    totals = cells.groupBy("week").agg(F.sum("amount").alias("total"))
    return cells.join(totals, "week").select(
        "week", "label", _exact("amount", 4).alias("amount"), _exact("total", 4).alias("total")
    )


_WIDE = 300


@query(
    "SELECT week AS \"Week\", "
    + ", ".join(f"SUM(CASE WHEN label = 'p{k}' THEN value ELSE 0 END) AS \"p{k}\"" for k in range(_WIDE))
    + ', SUM(value) AS "Total" FROM (SELECT strftime(date_trunc(\'week\', CAST(l_shipdate AS DATE)), \'%Y-%m-%d\') AS week,'
    f" 'p' || (l_orderkey % {_WIDE}) AS label, CAST(l_quantity AS DOUBLE) AS value FROM lineitem) GROUP BY week"
)
def wide_weekly_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pivot with more labels than a screen has columns: quantities by week and order number."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.date_format(F.date_trunc("week", "l_shipdate"), "yyyy-MM-dd").alias("week"),
        F.concat(F.lit("p"), F.col("l_orderkey") % _WIDE).alias("label"),
        F.col("l_quantity").cast("double").alias("value"),
    )
    return weekly_pivot(lines, "label", "value")


_BY_SKU = (
    "SELECT sku_name AS \"SKU\", CAST(COALESCE(SUM(total_quantity), 0) AS DOUBLE) AS \"Quantity\","
    " usage_unit AS \"Unit\", CAST(ROUND(COALESCE(SUM(usd), 0), 4) AS DOUBLE) AS \"USD\""
    " FROM rows_of_daily GROUP BY sku_name, usage_unit"
)


@query(t.sql(_BY_SKU, "rows_of_daily"))
def spend_by_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.spend_by_sku(_report_rows(spark, sf_dir)).select(
        "SKU", _exact("Quantity").alias("Quantity"), "Unit", _exact("USD").alias("USD")
    )


_BY_SERVICE = "SELECT service AS \"Service\", ROUND(SUM(blended_cost_usd), 2) AS \"USD\" FROM cloud_cost GROUP BY service"


@query(t.sql(_BY_SERVICE, "cloud_cost"))
def spend_by_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.spend_by_service(_cloud(spark, sf_dir)).withColumn("USD", F.round("USD", 2))


_COMBINED = (
    "SELECT 'Cloud' AS \"Cloud\", \"Service\", CAST(NULL AS DOUBLE) AS \"Quantity\", '—' AS \"Unit\", \"USD\""
    f" FROM ({_BY_SERVICE}) WHERE \"USD\" > 0 UNION ALL SELECT 'Platform', \"SKU\", \"Quantity\", \"Unit\","
    f" ROUND(\"USD\", 2) FROM ({_BY_SKU}) WHERE \"USD\" > 0"
)


def _combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.combined_totals(_cloud(spark, sf_dir), _report_rows(spark, sf_dir), CLOUD, PLATFORM)


@query(t.sql(_COMBINED, "cloud_cost", "rows_of_daily"))
def combined_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _combined(spark, sf_dir).withColumn("USD", F.round(F.round("USD", 4), 2))


@query(
    t.sql(
        f"SELECT \"Cloud\", ROUND(SUM(\"USD\"), 0) AS \"USD\" FROM ({_COMBINED}) GROUP BY ROLLUP (\"Cloud\")",
        "cloud_cost",
        "rows_of_daily",
    )
)
def spend_headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.headline(_combined(spark, sf_dir)).withColumn("USD", F.round("USD", 0))


@query(
    t.sql(
        "SELECT COALESCE(CAST(CAST(round_even(100 * CAST(COALESCE((SELECT SUM(usd) FROM entity), 0) AS DOUBLE)"
        " / NULLIF(CAST((SELECT SUM(usd) FROM daily) AS DOUBLE), 0), 0) AS BIGINT) AS VARCHAR), '?') AS attributed_pct",
        "entity",
        "daily",
    )
)
def attributed_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.attributed_share(_entity(spark, sf_dir), _daily(spark, sf_dir))


@query(t.sql("SELECT bool_or(estimated) AS any_estimated FROM cloud_cost", "cloud_cost"))
def any_estimated_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.any_estimated(_cloud(spark, sf_dir))


@query(
    t.sql(
        "SELECT (SELECT CAST(ROUND(SUM(usd), 4) AS DOUBLE) FROM entity) AS entity_usd,"
        " (SELECT ROUND(SUM(blended_cost_usd), 2) FROM cloud_cost) AS cloud_usd,"
        " (SELECT CAST(ROUND(SUM(usd), 4) AS DOUBLE) FROM daily) AS platform_usd",
        "entity",
        "daily",
        "cloud_cost",
    )
)
def grand_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    entity = _entity(spark, sf_dir).agg(_exact(F.sum("usd")).alias("usd")).scalar()
    cloud = _cloud(spark, sf_dir).agg(F.round(F.sum("blended_cost_usd"), 2).alias("usd")).scalar()
    platform = _daily(spark, sf_dir).agg(_exact(F.sum("usd")).alias("platform_usd"))
    return platform.select(entity.alias("entity_usd"), cloud.alias("cloud_usd"), "platform_usd")


@query(
    t.sql(
        "SELECT date AS \"Date\", service AS \"Service\", blended_cost_usd AS \"USD\", estimated AS \"Estimated\""
        " FROM cloud_cost WHERE blended_cost_usd > 0",
        "cloud_cost",
    )
)
def daily_cost_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.daily_cloud_detail(_cloud(spark, sf_dir))


_DETAIL = (
    "SELECT usage_date AS \"Date\", sku_name AS \"SKU\", CAST(total_quantity AS DOUBLE) AS \"Quantity\","
    " usage_unit AS \"Unit\", CAST(ROUND(usd, 4) AS DOUBLE) AS \"USD\" FROM rows_of_daily"
)


def _detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail = c.daily_usage_detail(_report_rows(spark, sf_dir))
    return detail.withColumns({"Quantity": _exact("Quantity"), "USD": _exact("USD")})


@query(t.sql(_DETAIL, "rows_of_daily"))
def daily_usage_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _detail(spark, sf_dir)


@query(
    t.sql(
        "SELECT CAST(\"Date\" AS VARCHAR) AS \"Date\", \"SKU\", printf('%.4f', \"Quantity\") AS \"Quantity\", \"Unit\","
        f" COALESCE(CASE WHEN \"USD\" IS NOT NULL THEN printf('%.4f', \"USD\") END, '—') AS \"USD\" FROM ({_DETAIL})",
        "rows_of_daily",
    )
)
def daily_usage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail table as report cells."""
    return format_report(_detail(spark, sf_dir))


@query(
    t.sql(
        "SELECT DISTINCT sku_name, regexp_replace(regexp_replace(sku_name, '^PREMIUM_', ''),"
        " '_(US|EU|AP|CA|SA|AF|ME)_[A-Z0-9_]+$', '') AS short, printf('%.4f', CAST(usage_quantity AS DOUBLE)) AS quantity"
        " FROM usage",
        "usage",
    )
)
def short_sku_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        t.usage(spark, sf_dir)
        .select("sku_name", short_sku(F.col("sku_name")).alias("short"), money(F.col("usage_quantity")).alias("quantity"))
        .distinct()
    )
