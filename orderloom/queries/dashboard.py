"""Dashboard queries and event series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.latest import latest_names
from orderloom.operators.series import cumulative_events, cumulative_totals, downsample
from orderloom.plans import dashboard as d
from orderloom.queries import tables as t
from orderloom.queries.registry import query
from orderloom.session import materialize
from orderloom.sources.events import event_times

RANGE = ("1997-01-01", "2000-12-31")


def gold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold written once for this query, which reads it twice: for the latest names and for the rows."""
    return materialize(t.gold(spark, sf_dir), "gold")


def dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.dashboard_dataset(gold_table(spark, sf_dir), *RANGE)


@query(t.sql("SELECT product_id, latest_name FROM latest", "latest"))
def latest_product_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_names(t.gold(spark, sf_dir))


@query(t.sql("SELECT a.*, l.latest_name FROM gold a JOIN latest l ON a.product_id = l.product_id", "gold", "latest"))
def gold_with_latest_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = gold_table(spark, sf_dir)
    return d.with_latest_name(gold, latest_names(gold))


@query(t.sql("SELECT * FROM gold WHERE order_date BETWEEN DATE '1997-01-01' AND DATE '2000-12-31'", "gold"))
def gold_in_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.in_date_range(t.gold(spark, sf_dir), *RANGE)


@query(t.sql("SELECT * FROM ds", "ds"))
def gold_dashboard_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset(spark, sf_dir)


@query(t.sql("SELECT SUM(total_value) AS total_value FROM ds", "ds"))
def kpi_total_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.kpi_value(dataset(spark, sf_dir))


@query(t.sql("SELECT CAST(SUM(total_orders) AS BIGINT) AS total_orders FROM ds", "ds"))
def kpi_total_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.kpi_orders(dataset(spark, sf_dir))


@query(t.sql("SELECT COUNT(DISTINCT customer) AS num_customers FROM ds", "ds"))
def kpi_num_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.kpi_customers(dataset(spark, sf_dir))


def _register_dimension(dimension: str) -> None:
    @query(
        t.sql(
            f"SELECT CAST(date_trunc('day', order_date) AS DATE) AS day, {dimension},"
            " SUM(total_value) AS total_value FROM ds GROUP BY 1, 2",
            "ds",
        ),
        name=f"daily_value_by_{dimension}",
    )
    def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
        return d.daily_by(dataset(spark, sf_dir), dimension)


for _dimension in d.DAILY:
    _register_dimension(_dimension)


_WIDGETS = (
    "SELECT 'totals' AS widget, CAST(NULL AS DATE) AS day, CAST(NULL AS VARCHAR) AS label, SUM(total_value) AS total_value,"
    " CAST(SUM(total_orders) AS BIGINT) AS total_orders, COUNT(DISTINCT customer) AS num_customers FROM ds"
    + "".join(
        f" UNION ALL SELECT '{dimension}', order_date, {dimension}, SUM(total_value), CAST(SUM(total_orders) AS BIGINT), NULL"
        f" FROM ds GROUP BY order_date, {dimension}"
        for dimension in d.DAILY
    )
)


@query(t.sql(_WIDGETS, "ds"))
def dashboard_widgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All numbers of the dashboard, its three totals and its three daily series, from one pass over the dataset."""
    return d.widgets(dataset(spark, sf_dir))


def _register_filter(dimension: str) -> None:
    @query(t.sql(f"SELECT DISTINCT {dimension} FROM ds", "ds"), name=f"filter_values_{dimension}")
    def values(spark: SparkSession, sf_dir: str) -> DataFrame:
        return d.filter_values(dataset(spark, sf_dir), dimension)


for _dimension in d.DIMENSIONS:
    _register_filter(_dimension)


@query(
    t.sql(
        "SELECT * FROM ds WHERE country IN ('NATION_1', 'NATION_2', 'NATION_3')"
        " AND category IN ('Category 1', 'Category 6') AND product IN ('red widget', 'red widget.1', 'blue bolt.1')",
        "ds",
    )
)
def dashboard_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.filter_dashboard(
        dataset(spark, sf_dir),
        country=("NATION_1", "NATION_2", "NATION_3"),
        category=("Category 1", "Category 6"),
        product=("red widget", "red widget.1", "blue bolt.1"),
    )


@query(
    t.sql(
        "SELECT * FROM ds WHERE customer IN (SELECT c_name FROM customer WHERE c_custkey IN (1, 2, 5, 8))", "ds"
    )
)
def dashboard_filtered_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = [f"Customer#{number:09d}" for number in (1, 2, 5, 8)]
    return d.filter_dashboard(dataset(spark, sf_dir), customer=chosen)


def _starred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_times(t.starred(spark, sf_dir), "starred_at")


_POINTS = (
    "SELECT event_time, CAST(ROW_NUMBER() OVER (ORDER BY event_time) AS BIGINT) AS total FROM stars"
    " UNION ALL SELECT MIN(event_time), 0 FROM stars"
)


@query(t.sql(_POINTS, "stars"), name="cumulative_event_series")
def cumulative_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cumulative_events(_starred(spark, sf_dir))


@query(
    t.sql(
        "SELECT event_time, events, CAST(SUM(events) OVER (ORDER BY event_time) - events AS BIGINT) AS before,"
        " CAST(SUM(events) OVER (ORDER BY event_time) AS BIGINT) AS total"
        " FROM (SELECT event_time, COUNT(*) AS events FROM stars GROUP BY event_time)",
        "stars",
    ),
    name="cumulative_event_totals",
)
def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cumulative_totals(_starred(spark, sf_dir))


@query(
    t.sql(
        f"SELECT event_time, total FROM ({_POINTS}) WHERE (SELECT COUNT(*) + 1 FROM stars) <= 200"
        " OR total = (SELECT COUNT(*) FROM stars)"
        " OR total IN (SELECT CAST(floor(i * ((SELECT COUNT(*) + 1 FROM stars) / 200.0)) AS BIGINT)"
        " FROM (SELECT unnest(range(200)) AS i))",
        "stars",
    ),
    name="cumulative_event_downsampled",
)
def downsampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return downsample(cumulative_totals(_starred(spark, sf_dir)))
