"""Bucketed lines and bitmap-indexed merges."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from orderloom.operators.colocated import Colocated, gold_in_place, silver_in_place
from orderloom.operators.idbitmap import BITS, SPAN, SPANS, IndexedTable
from orderloom.operators.orders import aggregate_orders, enrich_order
from orderloom.operators.tablewrites import merge_insert_only
from orderloom.queries import tables as t

SF_DIR = "/root/testdata/sf0.001"
PAIRS = T.StructType().add("k", T.LongType()).add("seq", T.IntegerType()).add("v", T.StringType())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def dimensions(spark):
    return t.customer(spark, SF_DIR), t.product(spark, SF_DIR)


@pytest.fixture
def sales(spark, lake):
    tables = Colocated(spark, lake.name("raw", "sales"), 4)
    tables.write(t.order(spark, SF_DIR), t.order_item(spark, SF_DIR), heavy_lines=6)
    return tables


def path_to_scan(plan, table):
    """The operators above the scan of ``table``, from the scan upwards."""
    lines = plan.split("\n")
    at = next(k for k, line in enumerate(lines) if "Scan" in line and table in line)
    path, depth = [], len(lines[at])
    for line in reversed(lines[: at + 1]):
        indent = len(line) - len(line.lstrip(" :+-*"))
        if indent < depth:
            depth = indent
            path.append(line.strip(" :+-*"))
    return path


@pytest.mark.parametrize("made", [silver_in_place, gold_in_place])
def test_lines_are_not_shuffled(spark, sales, no_broadcast, made):
    path = path_to_scan(plan_of(made(sales, *dimensions(spark))), "sales__lines")
    join = next(k for k, operator in enumerate(path) if "Join" in operator)
    assert not any("Exchange" in operator for operator in path[:join]), path
    above = [operator for operator in path if "Exchange hashpartitioning" in operator]
    assert len(above) == (0 if made is silver_in_place else 1), above  # gold groups its order sums


def test_same_rows_as_the_plain_joins(spark, sales):
    plain = enrich_order(t.customer(spark, SF_DIR), t.order(spark, SF_DIR), t.order_item(spark, SF_DIR), t.product(spark, SF_DIR))
    assert sales.heavy.count() > 0 and sales.lines.count() > 0
    assert rows(silver_in_place(sales, *dimensions(spark))) == rows(plain)
    cents = F.round("total_value", 2)
    expected = aggregate_orders(plain).withColumn("total_value", cents)
    assert rows(gold_in_place(sales, *dimensions(spark)).withColumn("total_value", cents)) == rows(expected)


def test_an_order_with_a_third_of_the_lines_has_no_bucket(spark, lake):
    lines = spark.range(9000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id = 1 THEN NULL ELSE id END AS id_order",
        "CAST(id AS INT) AS seq", "'x' AS desc_item", "1 AS qty", "CAST(1 AS FLOAT) AS total_item",
    )
    order = spark.range(9000).selectExpr(
        "id", "1L AS id_customer", "CAST(1 AS FLOAT) AS total", "'2024-01-01' AS date", "1L AS product_id"
    )
    customer = spark.createDataFrame([(1, "c", "US")], "id long, name string, country string")
    product = spark.createDataFrame([(1, "p", 1, "c")], "product_id long, name string, category_id int, category_name string")
    tables = Colocated(spark, lake.name("raw", "sales"), 4)
    tables.write(order, lines, heavy_lines=100)
    assert tables.heavy.count() == 3001 and tables.lines.filter("id_order = 7").isEmpty()
    sizes = [r["count"] for r in tables.lines.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 3000
    assert silver_in_place(tables, customer, product).count() == 8999
    assert rows(gold_in_place(tables, customer, product).select("total_quantity", "total_orders")) == [(8999, 5999)]


def test_rewritten_tables(spark, sales):
    sales.write(t.order(spark, SF_DIR).filter("id < 100"), t.order_item(spark, SF_DIR).filter("id_order < 100"))
    assert sales.exists() and sales.heavy.isEmpty()
    assert silver_in_place(sales, *dimensions(spark)).agg(F.max("order_id")).first()[0] < 100


# ---- bitmap index ---------------------------------------------------------------------------------


def pairs(spark, data):
    return spark.createDataFrame(data, PAIRS)


@pytest.fixture
def indexed(spark, lake):
    table = IndexedTable(spark, lake.name("raw", "things"), PAIRS, ("k", "seq"), span_shift=1)
    table.ensure()
    return table


def test_merge_equals_the_plain_merge(spark, lake, indexed):
    """NULL keys, repeated new keys, negative, huge and bordering ids."""
    ids = [0, 1, -1, BITS - 1, BITS, -BITS, 2 * BITS, 7, 2**53 + 1, 2**62, -(2**40), None]
    first = [(k, 1, "old") for k in ids[::2]] + [(7, 2, "old"), (5, None, "old")]
    second = [(k, s, "new") for k in ids for s in (1, 2)] + [(1, 1, "again"), (5, None, "new"), (None, None, "new")]
    plain = lake.name("raw", "plain")
    spark.createDataFrame([], PAIRS).write.saveAsTable(plain)
    for batch in (first, second, second):
        indexed.merge_insert_only(pairs(spark, batch))
        merge_insert_only(pairs(spark, batch), plain, PAIRS, ("k", "seq"))
        assert rows(indexed.read()) == rows(spark.table(plain))


def test_only_partitions_with_known_ids_are_read(spark, indexed):
    """New ids reach over the whole range; files of spans in which none of them is known may even be unreadable."""
    span = 2 * BITS
    indexed.merge_insert_only(pairs(spark, [(n * span + 5, 1, "old") for n in range(20)]))
    for row in spark.table(indexed.table).select(SPAN, "_metadata.file_path").distinct().collect():
        if row[SPAN] not in (3, 11):
            path = row[1].removeprefix("file://").removeprefix("file:")
            with open(path, "wb") as file:
                file.write(b"not parquet")
            crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
            if os.path.exists(crc):
                os.remove(crc)
    news = [(n * span + (5 if n in (3, 11) else 9), 1, "new") for n in range(40)]
    indexed.merge_insert_only(pairs(spark, news))
    readable = spark.table(indexed.table).filter(F.col(SPAN).isin(3, 11, 25))
    assert sorted(map(tuple, readable.select("k", "v").collect())) == [
        (3 * span + 5, "old"),
        (11 * span + 5, "old"),
        (25 * span + 9, "new"),
    ]


def test_index_holds_exactly_the_ids(spark, indexed):
    ids = [(k * k * 37, 1, "x") for k in range(300)]
    indexed.merge_insert_only(pairs(spark, ids[:150]))
    indexed.merge_insert_only(pairs(spark, ids))
    counted = spark.table(indexed.index).agg(F.sum(F.bitmap_count("ids"))).first()[0]
    assert counted == 300 == indexed.read().count()
    probe = pairs(spark, [(k, 1, "p") for k in range(0, 300 * 300 * 37, 5003)] + ids)
    found = indexed.known(probe, "_k")
    held = {k for k, _, _ in ids}
    assert all(r["_k"] == (r["k"] in held) for r in found.collect())
    before = rows(spark.table(indexed.index))
    indexed.rebuild()
    assert rows(spark.table(indexed.index)) == before


def test_an_index_ahead_of_its_table_loses_nothing(spark, indexed):
    """A run cut off between the index and the table: its rows go in when it is repeated."""
    indexed._add_ids(pairs(spark, [(1, 1, "x"), (900_000, 1, "x")]).withColumn(SPAN, indexed._span()))
    indexed.merge_insert_only(pairs(spark, [(1, 1, "x"), (900_000, 1, "x")]))
    assert rows(indexed.read()) == [(1, 1, "x"), (900_000, 1, "x")]


def test_empty_merge(spark, indexed):
    indexed.merge_insert_only(pairs(spark, []))
    assert indexed.read().isEmpty()


def test_far_ids_do_not_add_partitions(spark, indexed):
    """Ids of many more spans than there are partitions, in two merges: the partitions are bounded, the merge exact."""
    ids = [n * 2 * BITS + 3 for n in range(-50, 3 * SPANS)]
    indexed.merge_insert_only(pairs(spark, [(k, 1, "old") for k in ids[::2]]))
    indexed.merge_insert_only(pairs(spark, [(k, 1, "new") for k in ids]))
    assert rows(indexed.read()) == sorted(((k, 1, "new" if n % 2 else "old") for n, k in enumerate(ids)), key=repr)
    for table in (indexed.table, indexed.index):
        assert spark.table(table).select(SPAN).distinct().count() <= SPANS
    assert spark.table(indexed.index).agg(F.sum(F.bitmap_count("ids"))).first()[0] == len(ids)
