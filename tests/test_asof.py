"""The as-of sweep against the interval join."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from orderloom.operators import asof
from orderloom.operators.pricing import price_usage

START = dt.datetime(2024, 1, 1)
USAGE = "usage_end_time {kind}, sku_name string, n int, extra map<string,string>"
PRICES = (
    "sku_name string, price_start_time {kind}, price_end_time {kind},"
    " pricing struct<effective_list: struct<default: decimal(10,2)>>"
)


def frames(spark, usage, prices, kind="timestamp_ntz"):
    usage = spark.createDataFrame([(*u, {"a": "b"}) for u in usage], USAGE.format(kind=kind))
    prices = spark.createDataFrame([(s, a, b, ((p,),)) for s, a, b, p in prices], PRICES.format(kind=kind))
    return usage, prices


def minutes(n):
    return START + dt.timedelta(minutes=n)


def price(n):
    import decimal

    return decimal.Decimal(n).scaleb(-2)


def random_case(draw, skus=4, many=40, rows_=300):
    """Versions without overlap, with gaps, empty ones and open ends; usage on, between and outside of their borders."""
    prices = []
    for sku in range(skus):
        at = draw.randrange(0, 2000)
        for k in range(draw.randrange(0, many)):
            length = draw.choice([0, 1, 30, 2000])
            last = draw.random() < 0.03
            prices.append((f"s{sku}", minutes(at), None if last else minutes(at + length), price(k)))
            at += length + draw.choice([0, 0, 1, 3000])
            if last:
                break
    prices += [(None, minutes(0), None, price(1)), ("s0", None, minutes(1), price(2))]
    usage = [
        (None if draw.random() < 0.02 else minutes(draw.randrange(-100, 60_000)), draw.choice(["s0", "s1", "s2", "s9", None]), k)
        for k in range(rows_)
    ]
    usage += [(p[1], p[0], 1000 + k) for k, p in enumerate(prices)] + [(p[2], p[0], 2000 + k) for k, p in enumerate(prices)]
    return usage, prices


def shown(priced):
    return rows(priced.drop("extra"))


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("stretch_seconds, stretch_rows", [(86_400, 1_000_000), (3600, 3), (10**9, 50)])
def test_sweep_equals_the_interval_join(spark, kind, stretch_seconds, stretch_rows):
    usage, prices = frames(spark, *random_case(random.Random(stretch_rows)), kind)
    assert asof.overlapping_versions(prices).isEmpty()
    swept = asof.price_usage_by_sweep(usage.repartition(5), prices, stretch_seconds, stretch_rows)
    assert swept.columns == price_usage(usage, prices).columns
    assert shown(swept) == shown(price_usage(usage, prices))


def test_ten_thousand_versions_of_one_sku(spark):
    """The join would compare 100,000 usage rows with 10,000 versions each; no operator of the sweep makes that many rows."""
    usage = spark.range(100_000).select(
        (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("id") * 7 % 600_000).cast("decimal(18,6)"))).alias("usage_end_time"),
        F.lit("s").alias("sku_name"),
        F.col("id").cast("int").alias("n"),
    )
    begin = F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("id") * 60).cast("decimal(18,6)"))
    versions = spark.range(10_000).select(
        F.lit("s").alias("sku_name"),
        begin.alias("price_start_time"),
        (begin + F.expr("INTERVAL 60 SECONDS")).alias("price_end_time"),
        F.struct(F.struct(F.col("id").cast("decimal(10,2)").alias("default")).alias("effective_list")).alias("pricing"),
    )
    swept = asof.price_usage_by_sweep(usage, versions, stretch_rows=2_000)
    wrong = swept.filter(~F.col("priced") | (F.col("effective_price") != F.floor(F.col("n") * 7 % 600_000 / 60)))
    assert swept.count() == 100_000 and wrong.isEmpty()
    plan = swept._jdf.queryExecution().optimizedPlan().toString()
    assert "usage_end_time" not in "".join(line for line in plan.split("\n") if "Join" in line)


def test_rows_of_one_moment_spread(spark):
    """A third of all usage at one moment of one SKU is swept by many tasks."""
    usage = spark.range(0, 9000, 1, 6).select(
        F.lit(START).cast("timestamp_ntz").alias("usage_end_time"), F.lit("s").alias("sku_name"), F.col("id").cast("int").alias("n")
    )
    _, prices = frames(spark, [], [("s", minutes(-5), None, price(3))])
    swept = asof.price_usage_by_sweep(usage, prices, stretch_rows=500)
    assert swept.filter("priced AND effective_price = 0.03").count() == 9000
    spread = swept.groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) > 1


def test_overlaps_are_listed(spark):
    _, prices = frames(spark, [], [("s", minutes(0), minutes(10), price(1)), ("s", minutes(9), None, price(2)), ("s", minutes(20), None, price(3))])
    found = asof.overlapping_versions(prices).orderBy("price_start_time").collect()
    assert [r["next_start"] for r in found] == [minutes(9), minutes(20)]


def test_empty(spark):
    usage, prices = frames(spark, [(minutes(0), "s", 1)], [])
    assert shown(asof.price_usage_by_sweep(usage, prices)) == [(minutes(0), "s", 1, None, False)]
    assert asof.price_usage_by_sweep(usage.limit(0), prices).isEmpty()
