"""Digests, distinct counts by bitmaps, the account of dropped lines, and drifting cost documents."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

import golden
from conftest import rows
from orderloom import schemas
from orderloom.operators import digest
from orderloom.operators.distinctstate import id_state, record_days, wide_counts
from orderloom.operators.expect import ExpectationFailed, differences
from orderloom.operators.tablewrites import append_new, overwrite_table
from orderloom.plans import dashboard as d
from orderloom.plans import medallion as m
from orderloom.session import scratch_path
from orderloom.sources import costvariant
from orderloom.sources.costfeed import flatten_cost_json
from orderloom.streaming import account, freeze

# ---- digests --------------------------------------------------------------------------------------


def things(spark, data):
    return spark.createDataFrame(data, "k int, v string, f double, m map<string,int>")


def test_equal_tables_have_equal_digests(spark):
    data = [(k % 5 or None, f"v{k}", k / 3, {"b": k, "a": None}) for k in range(200)] * 2 + [(None, None, -0.0, None)]
    other = [(*r[:3], dict(reversed(r[3].items())) if r[3] else None) for r in data]
    random.Random(1).shuffle(other)
    assert digest.unequal_buckets(things(spark, other).repartition(7), things(spark, data), 16).isEmpty()
    digest.expect_same(things(spark, other), things(spark, data))


@pytest.mark.parametrize(
    "changed",
    [
        [(1, None, 1.0, None), (2, "a", 2.0, None)],  # where a NULL stands matters
        [(None, "a", 1.0, None), (2, "a", 2.0, None), (2, "a", 2.0, None)],  # and how often a row is there
        [(None, "a", 1.0, None)],
        [(None, "a", 1.0, {"a": 1}), (2, "a", 2.0, None)],
        [],
    ],
)
def test_any_change_shows(spark, changed):
    before = things(spark, [(None, "a", 1.0, None), (2, "a", 2.0, None)])
    after = things(spark, changed)
    assert not digest.unequal_buckets(after, before).isEmpty()
    with pytest.raises(ExpectationFailed):
        digest.expect_same(after, before)


def test_only_unequal_buckets_are_compared(spark):
    before = spark.range(0, 50_000, 1, 8).select("id", (F.col("id") * 2).alias("v"))
    after = before.withColumn("v", F.when(F.col("id") == 77, -1).otherwise(F.col("v")))
    assert digest.unequal_buckets(after, before).count() == 2
    found = digest.differences_by_digest(after, before)
    assert rows(found) == rows(differences(after, before)) == [(77, -1, 1), (77, 154, -1)]
    with pytest.raises(ExpectationFailed, match="'id': 77"):
        digest.expect_same(after, before)
    plan = digest.unequal_buckets(after, before)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.split("\n") if "Exchange" in line]
    assert moved and all("hashpartitioning(bucket" in line for line in moved)  # digests, not rows


# ---- distinct counts ------------------------------------------------------------------------------


def test_distinct_counts_add_up(spark, lake):
    draw = random.Random(3)
    days = [date(2024, 1, 30), date(2024, 1, 31), date(2024, 2, 1)]
    data = [
        (draw.choice(days), draw.choice(["US", None]), draw.choice([None, draw.randrange(40), 2**40 + draw.randrange(9), -5]))
        for _ in range(500)
    ]
    lines = spark.createDataFrame(data, "order_date date, country string, order_id long")
    table = lake.name("report", "ids")
    record_days(spark, table, lines.filter("order_id > 10"), ["country"], ["order_id"], days[1:])
    record_days(spark, table, lines, ["country"], ["order_id"], days)
    for period in (F.col("order_date"), F.trunc("order_date", "month"), F.lit(1)):
        expected = lines.groupBy(period.alias("period"), "country").agg(F.countDistinct("order_id").alias("n"))
        assert rows(wide_counts(spark.table(table), ["country"], period, ["order_id"])) == rows(expected)


def test_a_day_replaces_only_its_own_bits(spark, lake):
    table, day, next_day = lake.name("report", "ids"), date(2024, 1, 1), date(2024, 1, 2)
    shape = "order_date date, country string, order_id long"
    first = spark.createDataFrame([(day, "US", 1), (day, "US", 2), (next_day, "US", 2)], shape)
    record_days(spark, table, first, ["country"], ["order_id"], [day, next_day])
    record_days(spark, table, spark.createDataFrame([(day, "US", 9)], shape), ["country"], ["order_id"], [day])
    assert rows(wide_counts(spark.table(table), [], F.lit(1), ["order_id"])) == [(1, 2)]
    record_days(spark, table, spark.createDataFrame([], shape), ["country"], ["order_id"], [day])
    assert rows(wide_counts(spark.table(table), [], F.lit(1), ["order_id"])) == [(1, 1)]


def test_a_hot_customer_is_one_bit(spark):
    lines = spark.range(0, 60_000, 1, 8).selectExpr("DATE'2024-01-01' AS order_date", "'US' AS country", "IF(id % 3 = 0, 7, id % 50) AS c")
    state = id_state(lines, ["country"], ["c"])
    assert state.count() == 1
    assert wide_counts(state, ["country"], F.lit(1), ["c"]).first()["distinct_c"] == 50


def test_far_ids_take_no_more_than_themselves(spark, lake):
    """One id of a wide range after the other, negative and huge ones too: a number each, not a bitmap."""
    ids = [n * 40_009 for n in range(-100, 400)] + [2**62, -(2**62), -1, 63, 64]
    lines = spark.createDataFrame([(date(2024, 1, 1 + n % 3), k) for n, k in enumerate(ids + ids)], "order_date date, k long")
    state = id_state(lines, [], ["k"])
    assert 1000 < state.count() <= lines.distinct().count()
    assert all(f.dataType.simpleString() != "binary" for f in state.schema)
    table, days = lake.name("report", "ids"), [date(2024, 1, d) for d in (1, 2, 3)]
    record_days(spark, table, lines, [], ["k"], days)
    assert wide_counts(spark.table(table), [], F.lit(1), ["k"]).first()["distinct_k"] == len(set(ids))


# ---- dropped lines --------------------------------------------------------------------------------


def seed(spark, lake):
    for name, data, schema in (
        ("customer", golden.CUSTOMERS, schemas.customer_schema()),
        ("product", golden.LAKE_PRODUCTS, schemas.product_schema()),
        ("order", golden.LAKE_ORDERS, schemas.order_schema()),
        ("order_item", golden.LAKE_ITEMS, schemas.order_item_schema()),
    ):
        overwrite_table(spark.createDataFrame(data, schema), lake.name(m.SOURCE, name), schema)


def more_lines(spark, lake, data):
    spark.createDataFrame(data, schemas.order_item_schema()).write.insertInto(lake.name(m.SOURCE, "order_item"))


def consume(lake, offsets, **how):
    freeze.refresh_dimension_views(lake)
    freeze.stream_items(lake, offsets)
    account.stream_silver_accounted(lake, offsets, **how)


def state(lake):
    return [rows(lake.read(*name)) for name in (account.JOINED, account.DROPPED, account.ACCOUNT)]


def test_every_line_is_joined_or_listed(spark, lake):
    offsets = scratch_path(spark, "offsets")
    seed(spark, lake)
    consume(lake, offsets)
    append_new(
        spark.createDataFrame([(50, 999, 1.0, "2023-01-03", 1), (51, 10, 1.0, "2023-01-03", 777)], schemas.order_schema()),
        lake.name(m.SOURCE, "order"), schemas.order_schema(), ["id"],
    )
    more_lines(spark, lake, [(50, 1, "a", 1, 1.0), (51, 1, "b", 1, 1.0), (52, 1, "c", 1, 1.0), (None, 1, "d", 1, 1.0), (1, 9, "e", 1, 1.0)])
    consume(lake, offsets)
    assert sum(r["lines"] for r in lake.read(*account.ACCOUNT).collect()) == lake.read(m.SOURCE, "order_item").count()
    for r in lake.read(*account.ACCOUNT).collect():
        assert r["lines"] == r["matched"] + r["dropped"]
    second = lake.read(*account.DROPPED).filter("batch = 1").select("id_order", "reason")
    assert {tuple(r) for r in second.collect()} == {(50, "no customer"), (51, "no product"), (52, "no order"), (None, "no order")}
    # the same lines as through the plain stream
    freeze.stream_silver(lake, offsets)
    assert rows(lake.read(*account.JOINED).drop("batch")) == rows(lake.read(*freeze.SILVER))


def test_a_replayed_batch_changes_nothing(spark, lake):
    offsets = scratch_path(spark, "offsets")
    seed(spark, lake)
    consume(lake, offsets)
    more_lines(spark, lake, [(1, 9, "e", 1, 1.0), (404, 1, "f", 1, 1.0)])
    consume(lake, offsets)
    before = state(lake)
    again = spark.createDataFrame([(1, 9, "e", 1, 1.0), (404, 1, "f", 1, 1.0)], schemas.order_item_schema())
    account.write_batch(lake, again, 1)
    assert state(lake) == before
    consume(lake, offsets)  # nothing new
    assert state(lake) == before


def test_repeated_orders_count_a_line_once(spark, lake):
    offsets = scratch_path(spark, "offsets")
    seed(spark, lake)
    twice = spark.createDataFrame([(70, 10, 1.0, "2023-01-03", 1), (70, 999, 1.0, "2023-01-03", 1)] * 2, schemas.order_schema())
    twice.write.insertInto(lake.name(m.SOURCE, "order"))
    more_lines(spark, lake, [(70, 1, "a", 1, 1.0)])
    consume(lake, offsets)
    found = lake.read(*account.ACCOUNT).first()
    assert found["lines"] == lake.read(m.SOURCE, "order_item").count() == found["matched"] + found["dropped"]
    buyers = lake.read(m.SOURCE, "customer").filter("id = 10").count()
    assert lake.read(*account.JOINED).filter("order_id = 70").count() == 2 * buyers


def test_joined_lines_are_written_once(spark, lake, monkeypatch):
    """Only the judged lines are staged; a batch that comes again without a line that joins clears its partition."""
    offsets, labels, write = scratch_path(spark, "offsets"), [], account.materialize
    monkeypatch.setattr(account, "materialize", lambda df, label: labels.append(label) or write(df, label))
    seed(spark, lake)
    consume(lake, offsets)
    assert labels == ["judged-lines"]
    lost = spark.createDataFrame([(404, 1, "f", 1, 1.0)], schemas.order_item_schema())
    account.write_batch(lake, lost, 0)
    assert lake.read(*account.JOINED).isEmpty()
    assert [tuple(r) for r in lake.read(*account.DROPPED).select("id_order", "reason").collect()] == [(404, "no order")]
    assert [tuple(r) for r in lake.read(*account.ACCOUNT).collect()] == [(1, 0, 1, 0, 0)]


def test_full_refresh_accounts_anew(spark, lake):
    offsets = scratch_path(spark, "offsets")
    seed(spark, lake)
    consume(lake, offsets)
    before = state(lake)
    account.stream_silver_accounted(lake, offsets, full_refresh=True)
    assert state(lake) == before


# ---- cost documents -------------------------------------------------------------------------------

PLAIN = '{"ResultsByTime":[{"TimePeriod":{"Start":"2024-01-01"},"Estimated":true,"Groups":[{"Keys":["EC2"],"Metrics":{"BlendedCost":{"Amount":"1.5"}}}]}]}'


def documents(spark, *texts):
    return spark.createDataFrame([(x,) for x in texts], "payload string")


def test_plain_documents_give_the_same_rows(spark):
    found, problems = costvariant.read_cost_documents(documents(spark, PLAIN, PLAIN))
    assert found.schema.simpleString() == flatten_cost_json(documents(spark, PLAIN)).schema.simpleString()
    assert rows(found) == rows(flatten_cost_json(documents(spark, PLAIN, PLAIN)))
    assert problems.isEmpty()


@pytest.mark.parametrize(
    "drifted",
    [
        PLAIN.replace('"1.5"', "1.5"),
        PLAIN.replace("BlendedCost", "UnblendedCost"),
        PLAIN.replace('["EC2"]', '"EC2"'),
        PLAIN.replace('["EC2"]', '["EC2","eu"]').replace("true", '"true"'),
        PLAIN.replace("[{", "{").replace("}]", "}"),
        PLAIN.replace('{"Amount":"1.5"}', "1.5"),
        PLAIN.replace('"Keys"', '"Extra":{"a":[1]},"Keys"'),
    ],
)
def test_drifted_documents_give_the_same_rows(spark, drifted):
    found, problems = costvariant.read_cost_documents(documents(spark, drifted))
    assert rows(found) == [("2024-01-01", "EC2", 1.5, True, "2024-01-01")]
    assert problems.isEmpty()


@pytest.mark.parametrize(
    "bad, problem",
    [
        (PLAIN[:60], costvariant.NOT_JSON),
        (None, costvariant.NOT_JSON),
        ("[1, 2]", costvariant.NO_PERIODS),
        ('{"ResultsByTime":null}', costvariant.NO_PERIODS),
        (PLAIN.replace("2024-01-01", "soon"), costvariant.NO_DATE),
        (PLAIN.replace('"Groups"', '"Sets"'), costvariant.NO_GROUPS),
        (PLAIN.replace('["EC2"]', "[]"), costvariant.NO_KEY),
        (PLAIN.replace('"1.5"', '"much"'), costvariant.NO_AMOUNT),
    ],
)
def test_what_cannot_be_read_is_listed_beside_the_rows(spark, bad, problem):
    found, problems = costvariant.read_cost_documents(documents(spark, PLAIN, bad, PLAIN))
    assert found.count() == 2
    assert [tuple(r) for r in problems.select("payload", "problem").collect()] == [(bad, problem)]


def test_no_documents(spark):
    found, problems = costvariant.read_cost_documents(documents(spark).limit(0))
    assert found.isEmpty() and problems.isEmpty()


# ---- dashboard in one pass ------------------------------------------------------------------------


def dataset(spark):
    data = [
        (date(2024, 1, 1), "US", "Ann", "P1", "P1", "C1", 1.0, 1),
        (date(2024, 1, 1), "US", "Bob", "P1", "P1.1", "C1", 2.0, 1),
        (date(2024, 1, 2), None, "Ann", "P2", "P2", None, 4.0, 2),
        (date(2024, 1, 2), "UK", None, "P2", "P2", "C1", 8.0, 1),
    ]
    shape = "order_date date, country string, customer string, product string, product_name string, category string, total_value double, total_orders long"
    return spark.createDataFrame(data, shape)


def test_widgets_equal_the_single_queries(spark):
    base = dataset(spark)
    made = d.widgets(base)
    totals = made.filter("widget = 'totals'").first()
    assert totals["total_value"] == d.kpi_value(base).first()[0]
    assert totals["total_orders"] == d.kpi_orders(base).first()[0]
    assert totals["num_customers"] == d.kpi_customers(base).first()[0] == 2
    for dimension in d.DAILY:
        series = made.filter(F.col("widget") == dimension).select("day", "label", "total_value")
        assert rows(series) == rows(d.daily_by(base, dimension))


def test_widgets_read_the_dataset_once(spark):
    path = scratch_path(spark, "dataset")
    dataset(spark).write.parquet(path)
    plan = d.widgets(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_widgets_of_nothing(spark):
    assert [tuple(r) for r in d.widgets(dataset(spark).limit(0)).collect()] in ([], [("totals", None, None, None, None, 0)])
