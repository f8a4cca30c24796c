"""Cost documents whose shape drifts: read as VARIANT, with what cannot be read listed beside the rows.

``costfeed.flatten_cost_json`` takes one declared shape and fails on any other text. Here a document may lack
fields, have more of them, give amounts as numbers or as text, one key or several, or one period without a list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.columns import week_of
from orderloom.session import materialize

NOT_JSON, NO_PERIODS, NO_DATE, NO_GROUPS, NO_KEY, NO_AMOUNT = (
    "not JSON",
    "no periods",
    "period without date",
    "period without groups",
    "group without key",
    "amount is not a number",
)

#: Names of a cost's metric, the first that a group has.
METRICS = ("BlendedCost", "UnblendedCost", "AmortizedCost")


def _get(value: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(value, path, kind)


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _items(value: Column) -> Column:
    """``value`` as an array of variants: its elements, or itself if it is a lone object."""
    lone = F.when(_kind(value).startswith("OBJECT"), F.array(value))
    return F.when(_kind(value).startswith("ARRAY"), value.cast("array<variant>")).otherwise(lone)


def _exploded(df: DataFrame, value: Column, into: str, missing: str) -> DataFrame:
    """A row for each item; a document without one stays, with ``problem`` set, unless it has one already."""
    none = F.size(F.coalesce(_items(value), F.array().cast("array<variant>"))) == 0
    rows = df.withColumn("problem", F.coalesce("problem", F.when(none, F.lit(missing))))
    return rows.withColumn(into, F.explode_outer(F.when(F.col("problem").isNull(), _items(value))))


def read_cost_documents(documents: DataFrame, payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """(rows, problems) of documents, which are parsed once.

    ``rows`` are those of ``flatten_cost_json``: date, service, blended_cost_usd, estimated, week. ``problems`` has a
    row (payload, problem, date, service) for every document, period or group that gives no row.
    """
    parsed = documents.select(F.col(payload).alias("payload"), F.try_parse_json(F.col(payload)).alias("_doc"))
    parsed = parsed.withColumn("problem", F.when(F.col("_doc").isNull(), F.lit(NOT_JSON)))
    periods = _exploded(parsed, _get(F.col("_doc"), "$.ResultsByTime"), "_period", NO_PERIODS)
    period = F.col("_period")
    day = F.try_to_date(_get(period, "$.TimePeriod.Start", "string"))
    dated = periods.withColumns(
        {
            "date": F.when(day.isNotNull(), _get(period, "$.TimePeriod.Start", "string")),
            "estimated": F.coalesce(_get(period, "$.Estimated", "boolean"), F.lit(False)),
        }
    )
    dated = dated.withColumn("problem", F.coalesce("problem", F.when(day.isNull(), F.lit(NO_DATE))))
    groups = _exploded(dated, _get(period, "$.Groups"), "_group", NO_GROUPS)
    group = F.col("_group")
    keys = _get(group, "$.Keys")
    lone = F.when(~_kind(keys).rlike("^(ARRAY|OBJECT)"), _get(keys, "$", "string"))
    service = F.coalesce(_get(group, "$.Keys[0]", "string"), lone)
    amount = F.coalesce(
        *(_get(group, f"$.Metrics.{m}.Amount", "double") for m in METRICS),
        *(_get(group, f"$.Metrics.{m}", "double") for m in METRICS),
    )
    lacking = F.when(service.isNull(), F.lit(NO_KEY)).when(amount.isNull(), F.lit(NO_AMOUNT))
    flat = groups.select(
        "payload",
        F.coalesce("problem", lacking).alias("problem"),
        "date",
        service.alias("service"),
        amount.alias("blended_cost_usd"),
        "estimated",
        week_of(F.col("date")).alias("week"),
    )
    good = F.col("problem").isNull()
    kept = flat.withColumn("payload", F.when(~good, F.col("payload")))  # texts are stored for problems only
    stored = materialize(kept, "cost-rows")
    rows = stored.filter(good).select("date", "service", "blended_cost_usd", "estimated", "week")
    return rows, stored.filter(~good).select("payload", "problem", "date", "service")
