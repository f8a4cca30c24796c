from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from orderloom.functions import columns as x
from orderloom.operators.pivot import TooManyLabels, weekly_cells, weekly_pivot
from orderloom.operators.pricing import price_usage
from orderloom.operators.report import format_report
from orderloom.plans import costs as c
from orderloom.queries import tables as t
from orderloom.sources.costfeed import flatten_cost_json
from orderloom.sources.runs import run_summary, runs_on_day

USAGE = (
    "usage_date date, usage_end_time timestamp_ntz, sku_name string, cloud string, usage_quantity decimal(18,4),"
    " usage_unit string, usage_metadata struct<job_id:string,job_name:string,job_run_id:string,dlt_pipeline_id:string>"
)
PRICES = (
    "sku_name string, cloud string, price_start_time timestamp_ntz, price_end_time timestamp_ntz,"
    " pricing struct<default:decimal(18,6),effective_list:struct<default:decimal(18,6)>>"
)
CUT = datetime(2024, 1, 10)


def price(sku, start, end, list_price, effective=None):
    return (sku, "AWS", start, end, (Decimal(list_price), (Decimal(effective or list_price),)))


def used(when, sku, quantity, unit="DBU", job=None, name=None, run=None, pipe=None):
    return (when.date(), when, sku, "AWS", Decimal(quantity), unit, (job, name, run, pipe))


@pytest.fixture
def prices(spark):
    return spark.createDataFrame(
        [
            price("A", datetime(2023, 1, 1), CUT, "1"),
            price("A", CUT, None, "2"),
            price("B", datetime(2023, 1, 1), None, "3"),
        ],
        PRICES,
    )


@pytest.fixture
def usage(spark):
    return spark.createDataFrame(
        [
            used(datetime(2024, 1, 9, 23), "A", "10", job="j1", name="nightly", run="r1"),
            used(CUT, "A", "10", job="j1", name="nightly", run="r2"),
            used(datetime(2024, 1, 10, 5), "A", "1", pipe="p1"),
            used(datetime(2024, 1, 10, 6), "B", "2", unit=None, pipe="p2"),
            used(datetime(2024, 1, 10, 7), "C", "5", job="j2", run="r3"),
            used(datetime(2024, 1, 10, 8), "B", "4"),
            used(datetime(2022, 1, 1), "A", "7", job="j1", name="nightly", run="r0"),
        ],
        USAGE,
    )


@pytest.fixture
def pipelines(spark):
    return spark.createDataFrame(
        [
            ("p1", "old", datetime(2024, 1, 1)),
            ("p1", "etl", datetime(2024, 1, 5)),
            ("p2", "etl", datetime(2024, 1, 5)),
        ],
        "pipeline_id string, name string, change_time timestamp_ntz",
    )


@pytest.fixture(params=["broadcast", "shuffled"])
def join_route(spark, request):
    """The optimiser's own choice, and the one it makes for price lists too long to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    if request.param == "shuffled":
        spark.conf.set(key, "-1")
    yield request.param
    spark.conf.set(key, before)


def test_each_row_gets_the_version_in_force(usage, prices, join_route):
    priced = price_usage(usage, prices)
    assert priced.count() == usage.count()
    found = {r["usage_end_time"]: (r["effective_price"], r["priced"]) for r in priced.collect()}
    assert found[datetime(2024, 1, 9, 23)] == (Decimal("1"), True)
    assert found[CUT] == (Decimal("2"), True)
    assert found[datetime(2024, 1, 10, 7)] == (None, False)
    assert found[datetime(2022, 1, 1)] == (None, False)


def test_pricing_keeps_copies_of_a_hot_sku(spark, usage, prices, join_route):
    hot = usage.crossJoin(spark.range(50)).drop("id")
    assert price_usage(hot, prices).count() == 7 * 50


def test_pricing_of_nothing(usage, prices):
    assert price_usage(usage.filter("false"), prices).count() == 0


def test_spend_by_entity(usage, prices, pipelines):
    out = c.spend_by_entity(usage, prices, pipelines, days=30, as_of="2024-01-31")
    found = {(r["entity"], r["kind"], r["usage_unit"]): (r["quantity"], r["usd"], r["active_days"]) for r in out.collect()}
    assert found == {
        ("nightly", "job", "DBU"): (Decimal("20"), Decimal("30"), 2),
        ("etl", "pipeline", "DBU"): (Decimal("1"), Decimal("2"), 1),
        ("etl", "pipeline", None): (Decimal("2"), Decimal("6"), 1),
        ("(unnamed)", "job", "DBU"): (Decimal("5"), None, 1),
    }
    assert [r["entity"] for r in out.collect()][0] == "nightly"


def test_spend_by_day_and_unpriced(usage, prices):
    daily = c.spend_by_day_sku(usage, prices, days=30, as_of="2024-01-31")
    found = {(r["usage_date"].day, r["sku_name"], r["usage_unit"]): (r["usd"], r["unpriced_records"]) for r in daily.collect()}
    assert found[(10, "C", "DBU")] == (None, 1)
    assert found[(10, "A", "DBU")] == (Decimal("22"), 0)
    assert rows(c.unpriced_skus(daily)) == [("C",)]
    shown = c.usage_report_rows(daily)
    assert {r["usage_unit"] for r in shown.collect()} == {"DBU", "(none)"}
    by_sku = {(r["SKU"], r["Unit"]): r["USD"] for r in c.spend_by_sku(shown).collect()}
    assert by_sku == {("A", "DBU"): 32, ("B", "(none)"): 6, ("B", "DBU"): 12, ("C", "DBU"): 0}


def test_window_needs_a_day(usage):
    with pytest.raises(ValueError):
        c.in_trailing_window(usage, 0)


def test_sku_match_equals_the_plain_join(usage, prices):
    """Summing the versions first gives what the fanned-out join gives."""
    day = "2024-01-10"
    plain = (
        c.job_usage_on(usage, day)
        .join(prices, ["sku_name", "cloud"], "left")
        .groupBy("usage_metadata.job_id", "usage_metadata.job_name", "sku_name", "cloud")
        .agg(
            F.sum("usage_quantity").alias("total_dbu"),
            F.countDistinct("usage_metadata.job_run_id").alias("num_runs"),
            F.round(F.sum(F.col("usage_quantity") * F.col("pricing.default")), 2).alias("estimated_cost_usd"),
        )
    )
    ours = c.job_costs_on_date(usage, prices, day, "equi")
    assert rows(ours) == rows(plain)
    assert {r["job_id"]: r["total_dbu"] for r in ours.collect()} == {"j1": 20, "j2": 5}


def test_job_costs_by_interval_and_summary(usage, prices):
    costs = c.job_costs_on_date(usage, prices, "2024-01-10")
    assert {r["job_id"]: r["estimated_cost_usd"] for r in costs.collect()} == {"j1": Decimal("20"), "j2": None}
    assert tuple(c.job_cost_summary(costs).first()) == (2, Decimal("15"), Decimal("20"))
    shown = {r["job_id"]: (r["job_name"], r["estimated_cost_usd"]) for r in c.job_cost_rows(costs).collect()}
    assert shown == {"j1": ("nightly", 20), "j2": ("Unnamed", 0)}


def test_attributed_share(spark):
    schema = "usd decimal(18,2)"
    part = spark.createDataFrame([(Decimal("12.5"),)], schema)
    whole = spark.createDataFrame([(Decimal("100"),), (None,)], schema)
    assert c.attributed_share(part, whole).first()[0] == "12"
    assert c.attributed_share(part, whole.filter("false")).first()[0] == "?"
    assert c.attributed_share(part.filter("false"), whole).first()[0] == "0"
    assert c.attributed_share(part, spark.createDataFrame([(Decimal("0"),)], schema)).first()[0] == "?"


@pytest.fixture
def cloud(spark):
    document = (
        '{"ResultsByTime": [{"TimePeriod": {"Start": "2024-01-07"}, "Estimated": false, "Groups": ['
        '{"Keys": ["Amazon S3"], "Metrics": {"BlendedCost": {"Amount": "1.5"}}},'
        '{"Keys": ["AWS Free"], "Metrics": {"BlendedCost": {"Amount": "0"}}}]},'
        '{"TimePeriod": {"Start": "2024-01-08"}, "Estimated": true, "Groups": ['
        '{"Keys": ["Amazon S3"], "Metrics": {"BlendedCost": {"Amount": "2"}}},'
        '{"Keys": ["Tax"], "Metrics": {"BlendedCost": {"Amount": "0.25"}}}]}]}'
    )
    return flatten_cost_json(spark.createDataFrame([(document,)], "payload string"))


def test_cost_document(cloud):
    assert rows(cloud) == [
        ("2024-01-07", "AWS Free", 0.0, False, "2024-01-01"),
        ("2024-01-07", "Amazon S3", 1.5, False, "2024-01-01"),
        ("2024-01-08", "Amazon S3", 2.0, True, "2024-01-08"),
        ("2024-01-08", "Tax", 0.25, True, "2024-01-08"),
    ]


def test_broken_document_raises(spark):
    with pytest.raises(Exception):
        flatten_cost_json(spark.createDataFrame([("<html>",)], "payload string")).collect()


def test_cloud_pivot(cloud):
    wide = c.cloud_weekly_pivot(cloud)
    assert wide.columns == ["Week", "S3", "Tax", "Total"]
    assert rows(wide) == [("2024-01-01", 1.5, 0.0, 1.5), ("2024-01-08*", 2.0, 0.25, 2.25)]
    assert c.any_estimated(cloud).first()[0] is True
    assert c.daily_cloud_detail(cloud).count() == 3


def test_pivot_of_any_width(spark):
    rows_in = spark.range(900).selectExpr("'2024-01-01' AS week", "concat('s', id % 300) AS s", "1 AS usd")
    wide = weekly_pivot(rows_in, "s", "usd")
    assert len(wide.columns) == 302
    assert wide.first()["Total"] == 900


def test_pivot_long_form(spark, cloud):
    assert weekly_cells(cloud, "service", "blended_cost_usd").count() == 4
    nothing = weekly_pivot(cloud.filter("false"), "service", "blended_cost_usd")
    assert nothing.columns == ["Week", "Total"] and nothing.count() == 0


def test_pivot_week_with_only_free_services_stays(cloud):
    free = weekly_pivot(cloud.filter("date = '2024-01-07' AND service = 'AWS Free'"), "service", "blended_cost_usd")
    assert rows(free) == [("2024-01-01", 0.0)]


def test_combined_totals(usage, prices, cloud):
    shown = c.usage_report_rows(c.spend_by_day_sku(usage, prices, days=30, as_of="2024-01-31"))
    both = c.combined_totals(cloud, shown, "Cloud", "Platform")
    assert [tuple(r) for r in both.collect()] == [
        ("Cloud", "Amazon S3", None, "—", 3.5),
        ("Cloud", "Tax", None, "—", 0.25),
        ("Platform", "A", 21.0, "DBU", 32.0),
        ("Platform", "B", 4.0, "DBU", 12.0),
        ("Platform", "B", 2.0, "(none)", 6.0),
    ]
    assert rows(c.headline(both)) == [("Cloud", 3.75), ("Platform", 50.0), (None, 53.75)]
    assert c.combined_totals(None, None, "Cloud", "Platform") is None
    assert c.combined_totals(cloud, None, "Cloud", "Platform").count() == 2


def test_report_cells(spark):
    df = spark.createDataFrame([(1, 0.00001, None, None), (2, 2.5, "x", 1.0)], "a int, b double, c string, d float")
    assert rows(format_report(df)) == [("1", "0.0000", "—", "—"), ("2", "2.5000", "x", "1.0000")]


def test_runs_on_day(spark):
    ms = 1_705_017_600_000  # 2024-01-12 00:00 UTC
    runs = spark.createDataFrame(
        [
            (1, "n" * 39, ms, "TERMINATED"),
            (1, "n" * 38, ms + 86_399_999, None),
            (2, "", ms - 1, "RUNNING"),
            (3, None, ms + 86_400_000, "RUNNING"),
            (4, None, ms + 61_500, "RUNNING"),
        ],
        "job_id int, name string, start_time bigint, status string",
    )
    listed = runs_on_day(runs, "2024-01-12")
    assert rows(listed) == [
        (1, "n" * 35 + "...", "TERMINATED", "2024-01-12 00:00:00"),
        (1, "n" * 38, "UNKNOWN", "2024-01-12 23:59:59"),
        (4, "Unnamed", "RUNNING", "2024-01-12 00:01:01"),
    ]
    assert tuple(run_summary(listed).first()) == (3, 2)


def test_run_starts_round_to_the_millisecond(spark, tmp_path):
    """As in the SQL: half a millisecond before midnight counts to the next day."""
    moments = ["2024-01-11 23:59:59.999500", "2024-01-12 09:20:41.999784", "2024-01-12 23:59:59.999499", "1969-12-31 23:59:59.999500"]
    events = spark.createDataFrame([(n, m) for n, m in enumerate(moments)], "user_id bigint, ts string")
    events = events.select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), F.lit("view").alias("event_type"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    runs = t.runs(spark, str(tmp_path))
    day = 1_705_017_600_000  # 2024-01-12 00:00 UTC
    assert [r["start_time"] for r in runs.orderBy("job_id").collect()] == [day, day + 33_642_000, day + 86_399_999, -1]
    assert [r["started_at"] for r in runs_on_day(runs, "2024-01-12").orderBy("job_id").collect()] == [
        "2024-01-12 00:00:00", "2024-01-12 09:20:42", "2024-01-12 23:59:59",
    ]


def test_labels(spark):
    df = spark.createDataFrame(
        [("Amazon Simple Storage", "PREMIUM_JOBS_COMPUTE_US_EAST_OHIO", "2024-01-07"), ("AmazonX", "JOBS", "2024-01-08")],
        "service string, sku string, day string",
    )
    out = df.select(x.short_service(F.col("service")), x.short_sku(F.col("sku")), x.week_of(F.col("day")))
    assert rows(out) == [("AmazonX", "JOBS", "2024-01-08"), ("Simple Storage", "JOBS_COMPUTE", "2024-01-01")]


def test_days():
    assert x.as_day("2024-02-29") == date(2024, 2, 29)
    assert x.as_day(datetime(2024, 1, 1, 5)) == date(2024, 1, 1)
    assert x.as_day("  ") == x.as_day(None) == date.today()
    assert x.day_start_ms("1970-01-02") == 86_400_000


def test_pivot_of_too_many_labels_is_refused(spark):
    """No label is left out: the pivot raises, and the cells hold them all."""
    data = spark.range(30).selectExpr("'2024-01-01' AS week", "concat('l', id) AS s", "CAST(id AS DOUBLE) AS usd")
    with pytest.raises(TooManyLabels, match="weekly_cells"):
        weekly_pivot(data, "s", "usd", most_labels=28)
    assert len(weekly_pivot(data, "s", "usd", most_labels=29).columns) == 31  # one label sums to nothing
    assert weekly_cells(data, "s", "usd").count() == 30
