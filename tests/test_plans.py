"""Properties of the physical plans that matter at scale."""

import pytest
from pyspark.sql import functions as F

from orderloom.operators.keys import unmatched, with_keys_of, within_key_range
from orderloom.operators.orders import enrich_order, gold_from_bronze
from orderloom.operators.pricing import price_usage
from orderloom.operators.tablewrites import overwrite_table
from orderloom.plans import medallion as m
from orderloom.queries import tables as t
from orderloom.queries import writes
from orderloom.queries.all import ENTRIES
from orderloom.schemas import order_item_schema

SF_DIR = "/root/testdata/sf0.001"
WRITES = {name for name, entry in ENTRIES.items() if entry.run.__module__.endswith(".writes")}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", sorted(set(ENTRIES) - WRITES))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(ENTRIES[name].run(spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert operator not in plan


def parts(spark):
    return (t.customer(spark, SF_DIR), t.order(spark, SF_DIR), t.order_item(spark, SF_DIR), t.product(spark, SF_DIR))


def test_lines_are_shuffled_once(spark, no_broadcast):
    """Nation, customer, product and order joins shuffle two sides each; the lines are one of eight."""
    plan = plan_of(enrich_order(*parts(spark)))
    assert plan.count("Exchange hashpartitioning") == 8
    assert plan.count("Exchange hashpartitioning(order_id") == 2


def test_line_sums_reuse_the_join_partitioning(spark, no_broadcast):
    """Lines are shuffled by order for their sum; join and distinct count need no further shuffle by order."""
    plan = plan_of(gold_from_bronze(*parts(spark)))
    assert plan.count("Exchange hashpartitioning(id_order") == 1
    assert plan.count("Exchange hashpartitioning(order_id") == 1
    assert plan.count("Exchange hashpartitioning(customer_name") == 1


def test_an_order_with_a_third_of_the_lines_is_split(spark, no_broadcast):
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    }
    before = {key: spark.conf.get(key) for key in small}
    numbers = spark.range(1, 30_001, 1, 8)
    lines = numbers.selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 1000 END AS id_order",
        "CAST(id AS INT) AS seq",
        "uuid() AS desc_item",
        "1 AS qty",
        "CAST(id AS FLOAT) AS total_item",
    )
    order = spark.range(1000).selectExpr(
        "id", "id AS id_customer", "CAST(1 AS FLOAT) AS total", "'2024-01-01' AS date", "id AS product_id"
    )
    customer = spark.range(1000).selectExpr("id", "'c' AS name", "'US' AS country")
    product = spark.range(1000).selectExpr("id AS product_id", "'p' AS name", "1 AS category_id", "'c' AS category_name")
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        out = enrich_order(customer, order, lines, product)
        assert len(out.collect()) == 30_000
        assert "skew=true" in plan_of(out)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_scans_read_only_the_needed_columns(spark):
    plan = plan_of(gold_from_bronze(*parts(spark)))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_key_range_reaches_the_scan(spark, lake):
    table = lake.name("raw", "order_item")
    rows = spark.range(1, 1001).selectExpr(
        "CAST(id AS INT) id_order", "1 AS seq", "'x' AS desc_item", "1 AS qty", "CAST(1 AS FLOAT) total_item"
    )
    overwrite_table(rows, table, order_item_schema(), cluster_by=("id_order",))
    day = spark.range(500, 510).selectExpr("CAST(id AS INT) id")
    cut = within_key_range(spark.table(table), "id_order", day, "id")
    assert "GreaterThanOrEqual(id_order,500), LessThanOrEqual(id_order,509)" in plan_of(cut)
    assert cut.count() == 10
    assert within_key_range(spark.table(table), "id_order", day.filter("false"), "id").isEmpty()


def test_price_list_is_never_broadcast_by_hint(spark, no_broadcast):
    usage, prices = t.usage(spark, SF_DIR), t.list_prices(spark, SF_DIR)
    assert "BroadcastHashJoin" not in plan_of(price_usage(usage, prices))


def test_clustered_files_cover_disjoint_ranges(spark, lake):
    """Least and largest keys read from the written files: only files within a range need reading."""
    table = lake.name("raw", "order_item")
    rows = spark.range(1, 20_001).repartition(7).selectExpr(
        "CAST(id AS INT) id_order", "1 AS seq", "'x' AS desc_item", "1 AS qty", "CAST(1 AS FLOAT) total_item"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        overwrite_table(rows, table, order_item_schema(), cluster_by=("id_order",))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = spark.table(table).groupBy("_metadata.file_path").agg(F.min("id_order"), F.max("id_order")).collect()
    ranges = sorted((r[1], r[2]) for r in files)
    assert len(ranges) > 1
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def test_a_merge_shuffles_whole_rows_only_to_lay_them_out(spark, tmp_path):
    """Known rows are marked by their places in the files: the rows themselves go round the lookup's shuffles."""
    spark.range(5000).selectExpr("id AS k", "CAST(id % 3 AS INT) AS seq", "repeat('x', 50) AS v").write.parquet(str(tmp_path / "new"))
    new = spark.read.parquet(str(tmp_path / "new"))
    target = spark.range(0, 9000, 2).selectExpr("id AS k", "CAST(id % 3 AS INT) AS seq")
    left = unmatched(new, target, ["k", "seq"])
    plan = plan_of(left)
    assert "LeftAnti" not in plan
    schemas_read = [line.split("ReadSchema")[1] for line in plan.splitlines() if "ReadSchema" in line]
    assert len(schemas_read) > 1 and sum("v:string" in line for line in schemas_read) == 1
    assert sorted(r["k"] for r in left.collect()) == list(range(1, 5000, 2))


def test_the_days_lines_are_found_without_shuffling_the_others(spark):
    """Few wanted keys are broadcast, also where the frame they come from passes for a large one."""
    lines = spark.range(0, 20_000, 1, 4).selectExpr("IF(id % 50 = 0, NULL, id % 5000) AS id_order", "id AS seq")
    orders = spark.range(0, 2_000_000, 1, 4).selectExpr("IF(id % 7 = 0, NULL, id) AS id", "repeat('x', 50) AS pad").filter("id % 1000 = 5 OR id IS NULL")
    found = with_keys_of(lines, "id_order", orders, "id")
    expected = [(r, k) for k in range(20_000) if k % 50 and (r := k % 5000) % 1000 == 5 and r % 7]
    assert sorted((r["id_order"], r["seq"]) for r in found.collect()) == sorted(expected)
    plan = plan_of(found)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_first_load_and_second_day_share_no_line(spark, tmp_path):
    """Both days together hold every order and line once, an order without a date in the first; no line is shuffled for it."""
    sf = "/root/testdata/sf0.001"
    folder = str(tmp_path)
    for name in ("customer", "nation", "part", "lineitem"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    undated = F.when(F.col("o_orderkey") % 40 != 0, F.col("o_orderdate"))
    spark.read.parquet(f"{sf}/orders.parquet").withColumn("o_orderdate", undated).write.parquet(f"{folder}/orders.parquet")
    lake = writes.scratch_lake(spark)
    whole = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    writes._first_load(lake, spark, folder, writes.SECOND_DAY)
    early = lake.read(m.SOURCE, "order_item").count()
    assert lake.read(m.SOURCE, "order").filter("date IS NULL").count() > 0
    writes._second_day(lake, spark, folder, writes.SECOND_DAY)
    lines = lake.read(m.SOURCE, "order_item")
    assert 0 < early < lines.count() == whole
    assert lake.read(m.SOURCE, "order").count() == spark.read.parquet(f"{folder}/orders.parquet").count()
