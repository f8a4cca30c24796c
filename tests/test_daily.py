"""Orders by batch: the ledger of ids against checking all orders at once."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from orderloom import schemas
from orderloom.operators import quality as q
from orderloom.operators.orders import enrich_order
from orderloom.operators.uniqueness import BATCH, KeyLedger
from orderloom.plans import daily
from orderloom.plans import medallion as m
from orderloom.session import materialize

SHAPE = schemas.order_schema()


def frame(spark, data):
    return spark.createDataFrame(data, SHAPE)


def full_check(spark, data):
    """(valid, quarantined with rule names) of all orders at once."""
    annotated = q.annotate(frame(spark, data), q.order_rules())
    return rows(q.valid_rows(annotated)), rows(named(q.invalid_rows(annotated)))


def named(invalid):
    return invalid.select(*SHAPE.fieldNames(), F.col("_errors.name").alias("e"), F.col("_warnings.name").alias("w"))


def lake_state(lake):
    return rows(lake.read(*daily.VALID).drop(BATCH)), rows(named(lake.read(*daily.QUARANTINE)))


def some_orders(draw, many, ids):
    """Orders with repeated and missing ids, missing customers and totals over the limit."""
    return [
        (
            draw.choice([None, *range(ids)]) if draw.random() < 0.9 else draw.randrange(ids, 10**6),
            draw.choice([None, 1, 2, 3]) if draw.random() < 0.2 else 1,
            float(draw.choice([10, 999, 1001])),
            f"2024-01-0{draw.randrange(1, 4)}",
            draw.randrange(5),
        )
        for _ in range(many)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_days_equal_a_full_recompute(spark, lake, seed):
    draw = random.Random(seed)
    days = {name: some_orders(draw, 25, 60) for name in ("d1", "d2", "d3")}
    for name in ("d1", "d2", "d3"):
        daily.load_order_batch(lake, frame(spark, days[name]), name)
    assert lake_state(lake) == full_check(spark, sum(days.values(), []))
    # a corrected day replaces what it brought, and frees orders that only it repeated
    for name in ("d2", "d1"):
        days[name] = some_orders(draw, 25, 60)
        daily.load_order_batch(lake, frame(spark, days[name]), name)
        assert lake_state(lake) == full_check(spark, sum(days.values(), []))
    daily.load_order_batch(lake, frame(spark, days["d3"]), "d3")
    assert lake_state(lake) == full_check(spark, sum(days.values(), []))
    daily.load_order_batch(lake, frame(spark, []), "d1")
    assert lake_state(lake) == full_check(spark, days["d2"] + days["d3"])


def test_earlier_copy_is_quarantined_too(spark, lake):
    assert daily.load_order_batch(lake, frame(spark, [(1, 1, 5.0, "d", 1), (2, 1, 5.0, "d", 1)]), "d1")[:2] == (2, 0)
    assert daily.load_order_batch(lake, frame(spark, [(1, 1, 6.0, "d", 1), (3, 1, 2000.0, "d", 1)]), "d2")[:2] == (1, 2)
    valid, quarantined = lake_state(lake)
    assert [r[0] for r in valid] == [2, 3]
    assert [(r[0], r[2]) for r in quarantined] == [(1, 5.0), (1, 6.0), (3, 2000.0)]


def test_gate_leaves_valid_rows_and_ledger(spark, lake):
    daily.load_order_batch(lake, frame(spark, [(1, 1, 5.0, "d", 1)]), "d1")
    bad = frame(spark, [(1, 1, 5.0, "d", 1), (None, 1, 5.0, "d", 1)])
    with pytest.raises(q.QuarantineRatioExceeded):
        daily.load_order_batch(lake, bad, "d2", fail_ratio=0.5)
    assert lake.read(*daily.QUARANTINE).filter("batch = 'd2'").count() == 2
    assert [r[0] for r in lake_state(lake)[0]] == [1]
    assert daily.load_order_batch(lake, frame(spark, [(4, 1, 5.0, "d", 1)]), "d2", fail_ratio=0.5) == (1, 0, 0.0)
    assert lake_state(lake) == full_check(spark, [(1, 1, 5.0, "d", 1), (4, 1, 5.0, "d", 1)])


def files(lake, table, batch):
    found = lake.read(*table).filter(F.col(BATCH) == batch).select("_metadata.file_path").distinct().collect()
    return sorted(r[0] for r in found)


def test_untouched_days_keep_their_files(spark, lake):
    for name, ids in (("d1", (1, 2)), ("d2", (3, 4)), ("d3", (5, 6))):
        daily.load_order_batch(lake, frame(spark, [(k, 1, 5.0, "d", 1) for k in ids]), name)
    before = {name: files(lake, daily.VALID, name) for name in ("d1", "d2", "d3")}
    daily.load_order_batch(lake, frame(spark, [(7, 1, 5.0, "d", 1), (4, 1, 5.0, "d", 1)]), "d4")
    after = {name: files(lake, daily.VALID, name) for name in ("d1", "d2", "d3")}
    assert after["d1"] == before["d1"] and after["d3"] == before["d3"] and after["d2"] != before["d2"]


def scans(df):
    plan = df._jdf.queryExecution().analyzed().toString()
    return {line.split("spark_catalog.")[1].split(",")[0].split("[")[0] for line in plan.split("\n") if "spark_catalog." in line}


def test_a_day_reads_the_ledger_and_its_own_orders(spark, lake, monkeypatch):
    """What is compared to judge a batch: only the ledger among the lake's tables, and the written batch."""
    daily.load_order_batch(lake, frame(spark, [(k, 1, 5.0, "d", 1) for k in range(50)]), "d1")
    read = []
    monkeypatch.setattr(
        "orderloom.operators.uniqueness.materialize", lambda df, label: (read.append(df), materialize(df, label))[1]
    )
    ledger = KeyLedger(spark, lake.name(*daily.LEDGER), daily.KEYS)
    batch = materialize(frame(spark, [(7, 1, 5.0, "d", 1), (99, 1, 5.0, "d", 1)]))
    verdict = ledger.judge(batch, "d2")
    assert rows(verdict.repeated) == [(7,)] and rows(verdict.turned) == [(7, "d1", True)]
    tables = set().union(*(scans(df) for df in read))
    assert tables == {lake.name(*daily.LEDGER).replace("`", "")}
    plan = read[1]._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,7)" in plan and "LessThanOrEqual(id,99)" in plan


def test_null_ids_spread(spark):
    """Rows without an id go round the join on ids."""
    from orderloom.operators.uniqueness import flagged

    nulls = spark.range(0, 1000, 1, 8).selectExpr("CAST(NULL AS INT) AS id", "id AS v")
    made = flagged(nulls, materialize(spark.createDataFrame([(1,)], "id int")), ["id"], "_r")
    assert made.filter("_r").isEmpty() and made.count() == 1000
    assert made.select(F.spark_partition_id()).distinct().count() > 1


def test_history_equals_a_full_recompute(spark, lake):
    """The first load in batches by date, and a day of it that is loaded again, corrected."""
    draw = random.Random(7)
    history = some_orders(draw, 80, 50)
    history += [(None, 1, 1.0, None, 1), (3, 1, 1.0, None, 1)]
    assert daily.load_order_history(lake, frame(spark, history))[0] == len(full_check(spark, history)[0])
    assert lake_state(lake) == full_check(spark, history)
    day = "2024-01-02"
    corrected = some_orders(draw, 20, 50)
    corrected = [(*r[:3], day, r[4]) for r in corrected]
    daily.load_order_batch(lake, frame(spark, corrected), day)
    assert lake_state(lake) == full_check(spark, [r for r in history if r[3] != day] + corrected)


def test_history_gate(spark, lake):
    bad = frame(spark, [(1, 1, 5.0, "d", 1), (None, 1, 5.0, "d", 1)])
    with pytest.raises(q.QuarantineRatioExceeded):
        daily.load_order_history(lake, bad, fail_ratio=0.4)
    assert lake.read(*daily.QUARANTINE).count() == 1
    assert not spark.catalog.tableExists(lake.name(*daily.VALID).replace("`", ""))


def gold_rows(lake):
    return rows(lake.read("report", "order_agg").select(*schemas.gold_schema().fieldNames()))


def test_indexed_silver_equals_the_plain_one(spark, lake):
    sizes = m.SeedSizes(customers=500, products=100, orders=100, per_day=200)
    m.seed_sources(lake, "2024-01-01", sizes)
    daily.run_day(lake, "2024-01-01", silver_span_shift=1)
    m.seed_sources(lake, "2024-01-02", sizes)
    for _ in range(2):
        daily.run_day(lake, "2024-01-02", silver_span_shift=1)
        lines = enrich_order(*(lake.read(m.SOURCE, t) for t in ("customer", "order", "order_item", "product")))
        silver = lake.read("curated", "order_enriched")
        keys = ["order_id", "item_seq", "item_quantity", "item_total"]
        assert rows(silver.select(*keys)) == rows(lines.select(*keys))
    assert silver.select("id_span").distinct().count() >= 1
    renamed = silver.filter("product_name RLIKE '[.]1$'").select("order_date").distinct()
    assert [str(r[0]) for r in renamed.collect()] == ["2024-01-02"]  # frozen before


def test_run_day_by_batches_equals_the_full_run(spark, lake):
    """Seeded days, each run twice, through both forms of bronze give the same silver and gold."""
    sizes = m.SeedSizes(customers=500, products=100, orders=100, per_day=200)
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        m.seed_sources(lake, day, sizes)
        daily.run_day(lake, day)
    assert rows(lake.read(*daily.VALID).drop(BATCH)) == rows(lake.read(m.SOURCE, "order"))
    silver, gold = rows(lake.read("curated", "order_enriched")), gold_rows(lake)
    m.run_day(lake, "2024-01-02")  # the full form finds nothing to add and the same slice
    assert (rows(lake.read("curated", "order_enriched")), gold_rows(lake)) == (silver, gold)
    daily.run_day(lake, "2024-01-01")
    assert rows(lake.read(*daily.VALID).drop(BATCH)) == rows(lake.read(m.SOURCE, "order"))
    assert (rows(lake.read("curated", "order_enriched")), gold_rows(lake)) == (silver, gold)
