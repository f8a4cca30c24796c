"""Cumulative event series and their down-sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.columns import epoch_second
from orderloom.session import materialize

MAX_POINTS = 200
_CHUNK = 1_000_000


def cumulative_totals(events: DataFrame, time: str = "event_time") -> DataFrame:
    """(event_time, events, before, total) per distinct time.

    Equal times collapse to a count first, map-side. The running total is then built in three
    steps, none of which gathers the events: within a second (at most 1,000,000 microseconds),
    over the seconds of an hour (3,600), and over the hours, whose number depends on the time span
    only. The counts per time and per second feed several steps, so each is written once; the events
    are read and shuffled a single time.
    """
    kind = events.schema[time].dataType
    per_time = (
        events.filter(F.col(time).isNotNull())
        .groupBy(F.col(time).alias("event_time"))
        .agg(F.count(F.lit(1)).alias("events"))
        .withColumn("second", epoch_second(F.col("event_time"), kind))
    )
    per_time = materialize(per_time, "per_time")
    per_second = per_time.groupBy("second").agg(F.sum("events").alias("in_second"))
    per_second = materialize(per_second.withColumn("hour", F.floor(F.col("second") / 3600)), "per_second")
    per_hour = per_second.groupBy("hour").agg(F.sum("in_second").alias("in_hour"))

    over_hours = Window.orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    hour_starts = per_hour.select("hour", F.coalesce(F.sum("in_hour").over(over_hours), F.lit(0)).alias("hour_start"))
    in_hour = Window.partitionBy("hour").orderBy("second").rowsBetween(Window.unboundedPreceding, -1)
    second_starts = (
        per_second.withColumn("past", F.coalesce(F.sum("in_second").over(in_hour), F.lit(0)))
        .join(hour_starts, "hour")
        .select("second", (F.col("hour_start") + F.col("past")).alias("second_start"))
    )
    in_second = Window.partitionBy("second").orderBy("event_time").rowsBetween(Window.unboundedPreceding, -1)
    placed = per_time.withColumn("past", F.coalesce(F.sum("events").over(in_second), F.lit(0)))
    before = F.col("second_start") + F.col("past")
    return placed.join(second_starts, "second").select(
        "event_time", "events", before.alias("before"), (before + F.col("events")).alias("total")
    )


def cumulative_events(events: DataFrame, time: str = "event_time") -> DataFrame:
    """(event_time, total): the series 1..n over time, with a leading 0 at the first event.

    A time shared by very many events unfolds in chunks that are redistributed before unfolding.
    """
    totals = cumulative_totals(events, time)
    first = F.when(F.col("before") == 0, F.lit(0)).otherwise(F.col("before") + 1)
    spans = totals.select("event_time", first.alias("first"), F.col("total").alias("last"))
    chunks = spans.select(
        "event_time",
        F.explode(F.sequence(F.col("first"), F.col("last"), F.lit(_CHUNK).cast("bigint"))).alias("start"),
        "last",
    )
    stop = F.least(F.col("last"), F.col("start") + (_CHUNK - 1))
    return chunks.repartition("event_time", "start").select(
        "event_time", F.explode(F.sequence(F.col("start"), stop)).alias("total")
    )


def downsample(totals: DataFrame, points: int = MAX_POINTS) -> DataFrame:
    """(event_time, total): at most ``points`` evenly spaced points of the series, and the last one.

    Takes ``cumulative_totals``. Every row works out which sampled positions fall inside its own
    span, so nothing is unfolded and nothing is joined. A series of up to ``points`` entries is
    kept whole.
    """
    length = totals.agg(F.max("total").alias("n")).select(F.col("n") + 1).scalar()
    sized = totals.withColumn("length", length)
    stride = F.col("length") / F.lit(float(points))
    start = F.when(F.col("before") == 0, F.lit(0)).otherwise(F.col("before") + 1)
    spans = sized.select("event_time", start.alias("first"), F.col("total").alias("last"), "length", stride.alias("stride"))
    low = F.greatest(F.floor(F.col("first") / F.col("stride")) - 1, F.lit(0))
    high = F.least(F.ceil((F.col("last") + 1) / F.col("stride")), F.lit(points - 1))
    sampled = F.transform(
        F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>")),
        lambda i: F.floor(i * F.col("stride")),
    )
    mine = F.filter(sampled, lambda p: (p >= F.col("first")) & (p <= F.col("last")))
    final = F.when(F.col("last") == F.col("length") - 1, F.array(F.col("last"))).otherwise(F.array().cast("array<bigint>"))
    whole = F.sequence(F.col("first"), F.col("last"))
    chosen = F.when(F.col("length") <= points, whole).otherwise(F.array_union(mine, final))
    return spans.select("event_time", F.explode(chosen).alias("total"))
