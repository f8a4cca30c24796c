from datetime import date

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from orderloom.operators import tablewrites as w
from orderloom.schemas import SchemaDrift, check_schema, customer_schema

SLICED = T.StructType().add("day", T.DateType()).add("k", T.IntegerType()).add("v", T.IntegerType())
PAIRS = T.StructType().add("k", T.IntegerType()).add("v", T.StringType())
D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


@pytest.fixture
def table(lake):
    return lake.name("raw", "things")


@pytest.mark.parametrize(
    "ddl",
    [
        "id int, name string, country string, extra int",
        "id int, name string",
        "id int, title string, country string",
        "id bigint, name string, country string",
    ],
)
def test_drift_is_rejected_before_any_write(spark, table, ddl):
    w.overwrite_table(spark.createDataFrame([(1, "a", "US")], customer_schema()), table, customer_schema())
    drifted = spark.createDataFrame([], T.StructType.fromDDL(ddl))
    with pytest.raises(SchemaDrift):
        w.overwrite_table(drifted, table, customer_schema())
    with pytest.raises(SchemaDrift):
        w.merge_insert_only(drifted, table, customer_schema(), ["id"])
    assert rows(spark.table(table)) == [(1, "a", "US")]


def test_column_order_may_differ(spark):
    df = spark.createDataFrame([("US", 1, "a")], "country string, id int, name string")
    assert check_schema(df, customer_schema()).columns == ["id", "name", "country"]


def test_overwrite_may_read_its_target(spark, table):
    w.overwrite_table(spark.createDataFrame([(1, "a"), (2, "b")], PAIRS), table, PAIRS)
    w.overwrite_table(spark.table(table).filter("k = 2"), table, PAIRS)
    assert rows(spark.table(table)) == [(2, "b")]


def test_failing_overwrite_leaves_the_table(spark, table):
    w.overwrite_table(spark.createDataFrame([(1, "a")], PAIRS), table, PAIRS)
    broken = spark.table(table).withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception):
        w.overwrite_table(broken, table, PAIRS)
    assert rows(spark.table(table)) == [(1, "a")]
    w.overwrite_table(spark.createDataFrame([(3, "c")], PAIRS), table, PAIRS)
    assert rows(spark.table(table)) == [(3, "c")]


def test_interrupted_swap_is_finished(spark, table):
    spark.createDataFrame([(1, "a")], PAIRS).write.saveAsTable(w._standby(table))
    assert not w.needs_backfill(spark, table)
    assert rows(spark.table(table)) == [(1, "a")]


def test_ensure_and_backfill(spark, table):
    assert w.needs_backfill(spark, table)
    w.ensure_table(spark, table, PAIRS)
    w.ensure_table(spark, table, PAIRS)
    assert w.needs_backfill(spark, table)
    spark.createDataFrame([(1, "a")], PAIRS).write.insertInto(table)
    assert not w.needs_backfill(spark, table)


def test_append_new_twice(spark, table):
    w.ensure_table(spark, table, PAIRS)
    df = spark.createDataFrame([(1, "a"), (2, "b")], PAIRS)
    w.append_new(df, table, PAIRS, ["k"])
    w.append_new(df.union(spark.createDataFrame([(3, "c")], PAIRS)), table, PAIRS, ["k"])
    assert rows(spark.table(table)) == [(1, "a"), (2, "b"), (3, "c")]


def test_insert_only_merge(spark, table):
    w.overwrite_table(spark.createDataFrame([(1, "old"), (None, "old")], PAIRS), table, PAIRS)
    new = spark.createDataFrame([(1, "new"), (2, "x"), (2, "y"), (None, "new")], PAIRS)
    w.merge_insert_only(new, table, PAIRS, ["k"])
    assert rows(spark.table(table)) == sorted(
        [(1, "old"), (2, "x"), (2, "y"), (None, "new"), (None, "old")], key=repr
    )


def test_insert_only_merge_of_only_null_keys(spark, table):
    w.overwrite_table(spark.createDataFrame([(1, "old")], PAIRS), table, PAIRS)
    w.merge_insert_only(spark.createDataFrame([(None, "n")], PAIRS), table, PAIRS, ["k"])
    assert spark.table(table).count() == 2


def test_update_merge(spark, table):
    w.overwrite_table(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], PAIRS), table, PAIRS)
    updates = spark.createDataFrame([(1, "A"), (2, None), (9, "Z"), (None, "N")], PAIRS)
    w.merge_update(updates, table, ["k"], ["v"])
    assert rows(spark.table(table)) == sorted([(1, "A"), (2, None), (3, "c"), (None, "d")], key=repr)


def test_ambiguous_update(spark, table):
    w.overwrite_table(spark.createDataFrame([(1, "a")], PAIRS), table, PAIRS)
    with pytest.raises(w.AmbiguousUpdate):
        w.merge_update(spark.createDataFrame([(1, "A"), (1, "B")], PAIRS), table, ["k"], ["v"])
    assert rows(spark.table(table)) == [(1, "a")]


@pytest.fixture
def sliced(spark, table):
    w.overwrite_table(
        spark.createDataFrame([(D1, 1, 1), (D1, 2, 2), (D2, 1, 3)], SLICED), table, SLICED, partition_by=["day"]
    )
    return table


def test_replace_one_slice(spark, sliced):
    w.replace_slice(spark.createDataFrame([(D1, 5, 5)], SLICED), sliced, SLICED, "day", D1)
    w.replace_slice(spark.createDataFrame([(D3, 6, 6)], SLICED), sliced, SLICED, "day", D3)
    assert rows(spark.table(sliced).select("day", "k", "v")) == [(D1, 5, 5), (D2, 1, 3), (D3, 6, 6)]


def test_empty_slice_clears_that_day_only(spark, sliced):
    w.replace_slice(spark.createDataFrame([], SLICED), sliced, SLICED, "day", D1)
    w.replace_slice(spark.createDataFrame([], SLICED), sliced, SLICED, "day", D3)
    assert rows(spark.table(sliced).select("day", "k", "v")) == [(D2, 1, 3)]


@pytest.mark.parametrize("stray", [D2, None])
def test_rows_outside_the_slice_are_refused(spark, sliced, stray):
    with pytest.raises(w.RowsOutsideSlice):
        w.replace_slice(spark.createDataFrame([(D1, 5, 5), (stray, 5, 5)], SLICED), sliced, SLICED, "day", D1)
    assert spark.table(sliced).count() == 3


def test_replace_slice_restores_the_session_setting(spark, sliced):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    w.replace_slice(spark.createDataFrame([(D1, 5, 5)], SLICED), sliced, SLICED, "day", D1)
    assert spark.conf.get(key) == before


def test_partitioned_table_survives_repeated_overwrites(spark, sliced):
    for _ in range(2):
        w.overwrite_table(spark.table(sliced).withColumn("v", F.col("v") + 1), sliced, SLICED, partition_by=["day"])
    assert rows(spark.table(sliced).select("day", "k", "v")) == [(D1, 1, 3), (D1, 2, 4), (D2, 1, 5)]
    w.replace_slice(spark.createDataFrame([], SLICED), sliced, SLICED, "day", D1)
    assert rows(spark.table(sliced).select("day", "k", "v")) == [(D2, 1, 5)]


def same_rows(spark):
    return spark.range(0, 40_000, 1, 8).select(F.lit(1).alias("k"), F.lit("x").alias("v"))


def sizes_of(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_heavy_key_of_equal_rows_spreads_over_files(spark, table):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256")
    try:
        w.overwrite_table(same_rows(spark), table, PAIRS, cluster_by=["k"])
    finally:
        spark.conf.set(key, before)
    sizes = [r["count"] for r in spark.table(table).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) < 30_000


def test_heavy_partition_spreads_over_tasks(spark):
    sizes = sizes_of(w.by_partition(same_rows(spark), ["k"], []))
    assert sum(sizes) == 40_000 and max(sizes) < 20_000


def test_slice_of_an_unpartitioned_table_is_refused(spark, lake):
    table = lake.name("raw", "flat")
    rows = spark.createDataFrame([(k, k % 2 and "a" or "b", k) for k in range(10)], "v int, day string, k int")
    w.overwrite_table(rows, table, rows.schema)
    with pytest.raises(w.NotASlice):
        w.replace_slice(rows.filter("day = 'a'"), table, rows.schema, "day", "a")
    assert spark.table(table).count() == 10


def test_update_keeps_the_partitioning(spark, lake):
    table = lake.name("raw", "parted")
    rows = spark.createDataFrame([(k, k % 2 and "a" or "b", k) for k in range(10)], "v int, day string, k int")
    rows = rows.select("v", "k", "day")
    w.overwrite_table(rows, table, rows.schema, partition_by=["day"])
    w.merge_update(rows.selectExpr("k", "-1 AS v").filter("k = 3"), table, ["k"], ["v"])
    assert w.partition_columns(spark, table) == ["day"]
    w.replace_slice(rows.filter("day = 'b'"), table, rows.schema, "day", "b")
    assert spark.table(table).count() == 10
    assert spark.table(table).filter("v = -1").count() == 1
    with pytest.raises(w.PartitioningChanged):
        w.overwrite_table(rows, table, rows.schema, partition_by=["k"])


def file_names(spark, table, day):
    found = spark.table(table).filter(F.col("day").eqNullSafe(F.lit(day))).select("_metadata.file_path").distinct()
    return sorted(r[0] for r in found.collect())


def test_update_rewrites_only_partitions_with_a_matched_key(spark, table):
    data = [(D1, 1, 1), (D1, 2, 2), (D2, 3, 3), (D3, 1, 4), (None, 5, 5), (None, 6, 6)]
    w.overwrite_table(spark.createDataFrame(data, SLICED), table, SLICED, partition_by=["day"])
    before = {day: file_names(spark, table, day) for day in (D1, D2, D3, None)}
    w.merge_update(spark.createDataFrame([(1, 10), (9, 90)], "k int, v int"), table, ["k"], ["v"])
    assert rows(spark.table(table).select("day", "k", "v")) == sorted(
        [(D1, 1, 10), (D1, 2, 2), (D2, 3, 3), (D3, 1, 10), (None, 5, 5), (None, 6, 6)], key=repr
    )
    after = {day: file_names(spark, table, day) for day in (D1, D2, D3, None)}
    assert after[D2] == before[D2] and after[None] == before[None]
    assert not set(after[D1]) & set(before[D1]) and not set(after[D3]) & set(before[D3])
    w.merge_update(spark.createDataFrame([(5, 50)], "k int, v int"), table, ["k"], ["v"])
    assert file_names(spark, table, D1) == after[D1] and file_names(spark, table, None) != after[None]
    w.merge_update(spark.createDataFrame([(77, 0)], "k int, v int"), table, ["k"], ["v"])
    assert spark.table(table).filter("v = 50").count() == 1


def test_update_of_a_partition_column_moves_rows(spark, sliced):
    w.merge_update(spark.createDataFrame([(1, D3)], "k int, day date"), sliced, ["k"], ["day"])
    assert rows(spark.table(sliced).select("day", "k", "v")) == [(D1, 2, 2), (D3, 1, 1), (D3, 1, 3)]


def test_replaced_partitions(spark, sliced):
    """A touched partition without a row goes; a row elsewhere is refused before anything is written."""
    touched = [Row(day=D1), Row(day=D2)]
    w.replace_partitions(spark.table(sliced).filter("k = 2"), sliced, SLICED, touched)
    assert rows(spark.table(sliced).select("day", "k", "v")) == [(D1, 2, 2)]
    with pytest.raises(w.RowsOutsideSlice):
        w.replace_partitions(spark.createDataFrame([(D3, 1, 1), (None, 1, 1)], SLICED), sliced, SLICED, touched)
    assert spark.table(sliced).count() == 1


def test_tables_with_maps_are_laid_out(spark, table):
    data = spark.createDataFrame([(D1, 1, {"a": "b"})], "day date, k int, m map<string,string>")
    w.overwrite_table(data, table, data.schema, partition_by=["day"], cluster_by=["k"])
    assert spark.table(table).first()["m"] == {"a": "b"}


@pytest.mark.parametrize("name", [None, "it's", "a/b=c", "é"])
def test_emptied_partitions_of_any_name(spark, table, name):
    shape = T.StructType().add("k", T.IntegerType()).add("part", T.StringType())
    w.overwrite_table(spark.createDataFrame([(1, name), (2, "other")], shape), table, shape, partition_by=["part"])
    w.replace_partitions(spark.createDataFrame([], shape), table, shape, [Row(part=name)])
    assert rows(spark.table(table)) == [(2, "other")]
    w.replace_partitions(spark.createDataFrame([(3, name)], shape), table, shape, [Row(part=name)])
    assert spark.table(table).count() == 2


def test_one_partition_is_replaced_as_it_is_computed(spark, table):
    w.overwrite_table(spark.createDataFrame([(D1, 1, 1), (D2, 2, 2)], SLICED), table, SLICED, partition_by=("day",))
    w.replace_partition(spark.createDataFrame([(3, 3), (4, 4)], "k int, v int"), table, SLICED, Row(day=D1))
    assert rows(spark.table(table).select("day", "k")) == [(D1, 3), (D1, 4), (D2, 2)]
    w.replace_partition(spark.createDataFrame([], "k int, v int"), table, SLICED, Row(day=D1))
    assert rows(spark.table(table).select("day", "k")) == [(D2, 2)]
    with pytest.raises(w.NotASlice):
        w.replace_partition(spark.createDataFrame([(3, 3)], "k int, v int"), table, SLICED, Row(k=1))
    with pytest.raises(SchemaDrift):
        w.replace_partition(spark.createDataFrame([(3,)], "k int"), table, SLICED, Row(day=D2))
    assert rows(spark.table(table).select("day", "k")) == [(D2, 2)]
