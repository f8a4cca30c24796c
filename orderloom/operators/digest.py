"""Comparison of large tables by order-free digests of buckets.

Rows are dealt to buckets by their hash; a bucket's digest is its number of rows and the sums of two hashes. Equal
tables move one row a bucket and task; rows are compared only in buckets whose digests differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators.expect import ExpectationFailed, differences
from orderloom.schemas import check_schema

BUCKETS = 4096


def _parts(df: DataFrame) -> list[Column]:
    """What is hashed: every column and whether it is NULL, as a hash passes over NULLs; maps by their entries."""
    parts = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        kind = field.dataType.simpleString()
        if kind.startswith("map<"):
            column = F.to_json(F.array_sort(F.map_entries(column)))
        elif "map<" in kind:
            column = F.to_json(F.struct(column))
        parts += [column, column.isNull()]
    return parts


def _row_hash(df: DataFrame, salt: int) -> Column:
    return F.xxhash64(F.lit(salt), *_parts(df))


def _bucket(df: DataFrame, buckets: int) -> Column:
    return F.pmod(_row_hash(df, 0), F.lit(buckets))


def bucket_digests(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, rows, first, second): digests that do not depend on the order or place of the rows."""
    hashed = df.select(
        _bucket(df, buckets).alias("bucket"), *(_row_hash(df, k).cast("decimal(20,0)").alias(f"_h{k}") for k in (1, 2))
    )
    return hashed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("_h1").alias("first"), F.sum("_h2").alias("second")
    )


def unequal_buckets(actual: DataFrame, expected: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The buckets in which both sides, of equal schema, differ."""
    aligned = check_schema(actual, expected.schema, "actual")
    mine, theirs = bucket_digests(aligned, buckets), bucket_digests(expected, buckets)
    figures = ("rows", "first", "second")
    both = mine.unionByName(theirs.select("bucket", *((-F.col(c)).alias(c) for c in figures)))
    sums = both.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in figures))
    return sums.filter(" OR ".join(f"{c} <> 0" for c in figures)).select("bucket")


def differences_by_digest(actual: DataFrame, expected: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``differences``, with only the rows of unequal buckets compared. Runs the digests when called."""
    unequal = [r["bucket"] for r in unequal_buckets(actual, expected, buckets).collect()]  # at most ``buckets``
    aligned = check_schema(actual, expected.schema, "actual")
    return differences(*(df.filter(_bucket(df, buckets).isin(unequal)) for df in (aligned, expected)))


def expect_same(actual: DataFrame, expected: DataFrame, what: str = "table", buckets: int = BUCKETS) -> None:
    """Both sides hold the same rows with the same number of copies, however large they are."""
    if unequal_buckets(actual, expected, buckets).isEmpty():
        return
    found = differences_by_digest(actual, expected, buckets)
    some = [r.asDict() for r in found.limit(3).collect()]
    raise ExpectationFailed(f"{what}: {found.count()} distinct rows differ, among them {some}")
