"""Data-quality queries over deliberately dirty orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators import quality as q
from orderloom.queries import tables as t
from orderloom.queries.registry import query


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.annotate(t.dirty_order(spark, sf_dir), q.order_rules(t.DIRTY_LIMIT))


_ORDER = "id, id_customer, total, date, product_id"
_ERROR = "(no_id OR no_customer OR repeated)"


VALID_SQL = t.sql(f"SELECT {_ORDER} FROM checked WHERE NOT {_ERROR}", "checked")


@query(VALID_SQL)
def dq_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.valid_rows(annotated(spark, sf_dir))


INVALID_SQL = t.sql(
    f"SELECT {_ORDER}, concat_ws(',', CASE WHEN no_id THEN 'id_is_null_or_empty' END,"
    " CASE WHEN no_customer THEN 'id_customer_is_null_or_empty' END,"
    " CASE WHEN repeated THEN 'id_is_not_unique' END) AS errors,"
    " CASE WHEN over_limit THEN 'total_greater_than_limit' ELSE '' END AS warnings"
    f" FROM checked WHERE {_ERROR} OR over_limit",
    "checked",
)


def flat_quarantine(invalid: DataFrame) -> DataFrame:
    """Quarantined rows with the rule names as text."""

    def names(column: str):
        return F.coalesce(F.concat_ws(",", F.col(f"{column}.name")), F.lit(""))

    order = ("id", "id_customer", "total", "date", "product_id")
    return invalid.select(*order, names("_errors").alias("errors"), names("_warnings").alias("warnings"))


@query(INVALID_SQL)
def dq_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_quarantine(q.invalid_rows(annotated(spark, sf_dir)))


_METADATA_SQL = "'" + ",".join(f"{key}={value}" for key, value in sorted(q.COMPLETENESS.items())) + "'"


@query(
    t.sql(
        "SELECT id, 'id_is_null_or_empty' AS name, 'error' AS level FROM checked WHERE no_id"
        " UNION ALL SELECT id, 'id_customer_is_null_or_empty', 'error' FROM checked WHERE no_customer"
        " UNION ALL SELECT id, 'id_is_not_unique', 'error' FROM checked WHERE repeated"
        " UNION ALL SELECT id, 'total_greater_than_limit', 'warn' FROM checked WHERE over_limit",
        "checked",
    )
)
def dq_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.issues(q.invalid_rows(annotated(spark, sf_dir)), "id")


@query(
    t.sql(
        "SELECT id, 'id_is_null_or_empty' AS name, 'id is null or empty' AS message, 'id' AS columns, "
        + _METADATA_SQL
        + " AS metadata FROM checked WHERE no_id"
        " UNION ALL SELECT id, 'id_customer_is_null_or_empty', 'id_customer is null or empty', 'id_customer', "
        + _METADATA_SQL
        + " FROM checked WHERE no_customer"
        " UNION ALL SELECT id, 'id_is_not_unique', '(id) occurs more than once', 'id', '' FROM checked WHERE repeated"
        f" UNION ALL SELECT id, 'total_greater_than_limit', 'total is greater than {t.DIRTY_LIMIT}', 'total', ''"
        " FROM checked WHERE over_limit",
        "checked",
    )
)
def dq_issue_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything an issue carries: message, columns and metadata, as text."""
    invalid = q.invalid_rows(annotated(spark, sf_dir))
    none = F.array().cast(q.ISSUE)
    both = F.concat(F.coalesce("_errors", none), F.coalesce("_warnings", none))
    one = invalid.select("id", F.explode(both).alias("i"))
    pairs = F.transform(F.array_sort(F.map_entries("i.metadata")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return one.select(
        "id",
        F.col("i.name").alias("name"),
        F.col("i.message").alias("message"),
        F.concat_ws(",", "i.columns").alias("columns"),
        F.coalesce(F.concat_ws(",", pairs), F.lit("")).alias("metadata"),
    )


_COUNTS = f"COUNT(*) FILTER (NOT {_ERROR}) AS valid, COUNT(*) FILTER ({_ERROR} OR over_limit) AS invalid"


@query(
    t.sql(
        "SELECT valid, invalid, ROUND(CAST(invalid AS DOUBLE) / (valid + invalid), 6) AS ratio"
        f" FROM (SELECT {_COUNTS} FROM checked)",
        "checked",
    )
)
def dq_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.dq_ratio(annotated(spark, sf_dir)).withColumn("ratio", F.round("ratio", 6))


@query(
    t.sql(
        "SELECT valid, invalid, ROUND(CAST(invalid AS DOUBLE) / n, 6) AS ratio"
        f" FROM (SELECT {_COUNTS}, COUNT(*) AS n FROM checked)",
        "checked",
    )
)
def dq_ratio_by_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.dq_ratio(annotated(spark, sf_dir), "rows").withColumn("ratio", F.round("ratio", 6))


@query(
    t.sql(
        "SELECT id, COUNT(*) AS copies FROM dirty WHERE id IS NOT NULL GROUP BY id HAVING COUNT(*) > 1", "dirty"
    )
)
def duplicate_order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.repeated_keys(t.dirty_order(spark, sf_dir), ["id"])


@query(
    t.sql(
        "SELECT id, total, total > 450000 AS over_limit FROM dirty WHERE total > 450000", "dirty"
    )
)
def orders_over_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule on its own."""
    checked = q.annotate(t.dirty_order(spark, sf_dir), [q.rule_max("total", t.DIRTY_LIMIT)])
    return q.invalid_rows(checked).select("id", "total", F.col("_warnings").isNotNull().alias("over_limit"))


@query(t.sql("SELECT id_customer, total, date FROM dirty WHERE id IS NULL OR id_customer IS NULL", "dirty"))
def orders_missing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = q.annotate(t.dirty_order(spark, sf_dir), q.rule_not_empty(["id", "id_customer"]))
    return q.invalid_rows(checked).select("id_customer", "total", "date")
