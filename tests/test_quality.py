import pytest
from pyspark.sql import functions as F

from conftest import rows
from golden import DIRTY_ORDERS as DIRTY
from orderloom import schemas
from orderloom.operators import quality as q


@pytest.fixture
def annotated(spark):
    return q.annotate(spark.createDataFrame(DIRTY, schemas.order_schema()), q.order_rules())


def test_split_and_issues(annotated):
    valid, invalid = q.split(annotated)
    assert valid.schema == schemas.order_schema()
    assert [r[0] for r in rows(valid)] == [1, 2]
    assert invalid.count() == 4
    assert rows(q.issues(invalid, "id").select("id", "name")) == sorted(
        [
            (None, "id_is_null_or_empty"),
            (2, "total_greater_than_limit"),
            (3, "id_is_not_unique"),
            (3, "id_is_not_unique"),
        ],
        key=repr,
    )


def test_issue_struct_carries_metadata(annotated):
    found = annotated.filter("id IS NULL").select(F.explode("_errors").alias("e")).first()["e"]
    assert found["columns"] == ["id"]
    assert found["metadata"] == q.COMPLETENESS
    schemas.check_schema(q.invalid_rows(annotated), schemas.quarantine_schema())


def test_ratio_counts_warned_rows_twice_unless_asked(annotated):
    assert tuple(q.dq_ratio(annotated).first()) == (2, 4, pytest.approx(4 / 6))
    assert q.dq_ratio(annotated, "rows").first()["ratio"] == pytest.approx(4 / 5)


def test_ratio_of_nothing_is_zero(annotated):
    assert tuple(q.dq_ratio(annotated.filter("false")).first()) == (0, 0, 0.0)


def test_gate_is_strict():
    q.gate(2, 4, 0.5, 0.5)
    with pytest.raises(q.QuarantineRatioExceeded):
        q.gate(2, 4, 0.51, 0.5)


def test_null_total_passes_blank_text_fails(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 5.0, "  "), (3, 5.0, None)], "id int, total double, label string")
    checked = q.annotate(df, [q.rule_max("total", 4), *q.rule_not_empty(["label"])])
    assert rows(q.issues(checked, "id").select("id", "name")) == [
        (2, "label_is_null_or_empty"),
        (2, "total_greater_than_limit"),
        (3, "label_is_null_or_empty"),
        (3, "total_greater_than_limit"),
    ]


def test_several_null_keys_are_not_duplicates(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, None), (1, None), (2, 2), (2, 2)], "a int, b int")
    checked = q.annotate(df, [q.rule_unique(["a", "b"])])
    assert rows(q.invalid_rows(checked).select("a", "b")) == [(2, 2), (2, 2)]


def test_uniqueness_without_broadcast(spark):
    """The shuffled route, with most rows under a NULL key and one key holding a third."""
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") < n // 3, F.lit(7)).when(F.col("id") >= 2 * n // 3, F.col("id")).alias("id"),
        F.lit(1).alias("v"),
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        checked = q.annotate(df, [q.rule_unique(["id"])])
        assert checked.count() == n
        assert rows(q.invalid_rows(checked).groupBy("id").count()) == [(7, n // 3)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("data", [[(1, 1, 5.0, "d", 1), (1, 1, 5.0, "d", 1), (2, 1, 2000.0, "d", 1)], []])
def test_observed_counts_equal_a_count_of_their_own(spark, data):
    """The pass that writes the quarantine also counts, and reads the annotated rows once."""
    annotated = q.annotate(spark.createDataFrame(data, schemas.order_schema()), q.order_rules())
    counting, seen = q.observed(annotated)
    counting = q.invalid_rows(counting)
    assert counting._jdf.queryExecution().optimizedPlan().toString().count("CollectMetrics") == 1
    counting.write.format("noop").mode("overwrite").save()
    for denominator in ("outputs", "rows"):
        assert q.observed_ratio(seen, denominator) == tuple(q.dq_ratio(annotated, denominator).first())
