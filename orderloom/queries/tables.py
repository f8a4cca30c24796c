"""The driver's tables in the shapes the library works on.

``customer``, ``order`` and so on return DataFrames; ``CTES`` holds the same relations as SQL text.
Identifiers are 64-bit, as in the driver's tables. ``item_seq`` is the line number, which the driver's
data may repeat within an order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.columns import epoch_second
from orderloom.operators.orders import GOLD_KEYS, book_orders, enrich_order, gold_from_booked
from orderloom.session import tune

RENAME_DAY = "1998-01-01"
PRICE_CUT = "2024-01-15 00:00:00"
PRICE_START = "2023-01-01 00:00:00"
FIRST_REVISION = "2023-06-01 00:00:00"
SECOND_REVISION = "2024-01-10 00:00:00"
ESTIMATED_FROM = "2001-10-01"
DIRTY_LIMIT = 450_000


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = load(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    people = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("n_nationkey")
    )
    return people.join(nation, "n_nationkey").select("id", "name", "country")


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    category = (F.pmod(F.col("p_partkey"), F.lit(10)) + 1).cast("int")
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").cast("float").alias("unit_price"),
        category.alias("category_id"),
        F.concat(F.lit("Category "), category.cast("string")).alias("category_name"),
    )


def order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders; the product is spread over all parts by order number."""
    parts = load(spark, sf_dir, "part").agg(F.count(F.lit(1)).alias("parts")).scalar()
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("id_customer"),
        F.col("o_totalprice").cast("float").alias("total"),
        F.to_date("o_orderdate").cast("string").alias("date"),
        F.pmod(F.col("o_orderkey"), parts).alias("product_id"),
    )


def order_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id_order"),
        F.col("l_linenumber").alias("seq"),
        F.concat(F.lit("Item_"), F.col("l_partkey")).alias("desc_item"),
        F.col("l_quantity").cast("int").alias("qty"),
        F.col("l_extendedprice").cast("float").alias("total_item"),
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_order(
        customer(spark, sf_dir), order(spark, sf_dir), order_item(spark, sf_dir), product(spark, sf_dir)
    )


def _renamed(name: Column) -> Column:
    late = (F.col("product_id") % 5 == 0) & (F.col("order_date") >= F.to_date(F.lit(RENAME_DAY)))
    return F.when(late, F.concat(name, F.lit(".1"))).otherwise(name)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold in which every fifth product was renamed for orders from ``RENAME_DAY`` on."""
    booked = book_orders(customer(spark, sf_dir), order(spark, sf_dir), product(spark, sf_dir))
    frozen = booked.withColumn("product_name", _renamed(F.col("product_name")))
    return gold_from_booked(frozen, order_item(spark, sf_dir))


def dirty_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with missing ids (every 97th) and repeated rows (every 101st)."""
    clean = order(spark, sf_dir)
    copies = F.when(F.col("id") % 101 == 0, F.lit(2)).otherwise(F.lit(1))
    twice = clean.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")
    return twice.withColumn("id", F.when(F.col("id") % 97 != 0, F.col("id")))


def _sku(event_type: Column) -> Column:
    return F.concat(F.lit("PREMIUM_"), F.upper(event_type), F.lit("_COMPUTE_US_EAST_OHIO"))


def _cloud(event_type: Column) -> Column:
    return F.when(event_type.isin("click", "purchase"), F.lit("AWS")).otherwise(F.lit("AZURE"))


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as billing usage: a third belongs to jobs, a third to pipelines, a third to neither."""
    kind, user = F.col("event_type"), F.col("user_id")
    unit = F.when(kind.isin("click", "view"), F.lit("DBU")).when(kind == "error", F.lit("DSU"))
    unit = unit.when(kind == "purchase", F.lit("GB"))
    job, named = user % 3 == 0, user % 2 == 0
    metadata = F.struct(
        F.when(job, user.cast("string")).alias("job_id"),
        F.when(job & named, F.concat(F.lit("job_"), user % 7)).alias("job_name"),
        F.when(job, F.concat(F.lit("run_"), F.col("event_id") % 50)).alias("job_run_id"),
        F.when(user % 3 == 1, user.cast("string")).alias("dlt_pipeline_id"),
    )
    return load(spark, sf_dir, "events").select(
        F.to_date("ts").alias("usage_date"),
        F.col("ts").alias("usage_end_time"),
        _sku(kind).alias("sku_name"),
        _cloud(kind).alias("cloud"),
        F.col("value").cast("decimal(18,4)").alias("usage_quantity"),
        unit.alias("usage_unit"),
        metadata.alias("usage_metadata"),
    )


def _moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def list_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two price versions per event type, cut mid-window; sign-ups have no price."""
    kinds = load(spark, sf_dir, "events").select("event_type").filter("event_type <> 'signup'").distinct()
    versions = kinds.withColumn("version", F.explode(F.sequence(F.lit(1), F.lit(2))))
    first = F.col("version") == 1
    cents = F.length("event_type") * 5 + F.col("version")
    price = (cents.cast("decimal(18,6)") / F.lit(100)).cast("decimal(18,6)")
    effective = (cents.cast("decimal(18,6)") * F.lit(9) / F.lit(1000)).cast("decimal(18,6)")
    return versions.select(
        _sku(F.col("event_type")).alias("sku_name"),
        _cloud(F.col("event_type")).alias("cloud"),
        F.when(first, _moment(PRICE_START)).otherwise(_moment(PRICE_CUT)).alias("price_start_time"),
        F.when(first, _moment(PRICE_CUT)).alias("price_end_time"),
        F.struct(
            price.alias("default"), F.struct(effective.alias("default")).alias("effective_list")
        ).alias("pricing"),
    )


def pipelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two revisions per pipeline; several pipelines share a name."""
    owners = load(spark, sf_dir, "events").select("user_id").filter("user_id % 3 = 1").distinct()
    revisions = owners.withColumn("revision", F.explode(F.sequence(F.lit(1), F.lit(2))))
    name = F.concat(F.lit("pipe_"), F.col("user_id") % 7, F.lit("_v"), F.col("revision"))
    first = F.col("revision") == 1
    return revisions.select(
        F.col("user_id").cast("string").alias("pipeline_id"),
        name.alias("name"),
        F.when(first, _moment(FIRST_REVISION)).otherwise(_moment(SECOND_REVISION)).alias("change_time"),
    )


def cost_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON cost document per ship date, listing the cost of each service on that date.

    Costs are summed per date and service before the document is built, so a document holds one
    entry per service.
    """
    flag = F.col("l_returnflag")
    prefix = F.when(flag == "A", F.lit("Amazon ")).when(flag == "R", F.lit("AWS ")).otherwise(F.lit(""))
    free = (flag == "N") & (F.col("l_linestatus") == "O")
    amount = F.when(free, F.lit(0)).otherwise(F.col("l_extendedprice")).cast("decimal(18,2)")
    per_service = (
        load(spark, sf_dir, "lineitem")
        .groupBy(
            F.to_date("l_shipdate").alias("day"),
            F.concat(prefix, F.lit("Flag "), flag, F.col("l_linestatus")).alias("service"),
        )
        .agg(F.sum(amount).cast("string").alias("amount"))
    )
    entry = F.struct(
        F.array("service").alias("Keys"),
        F.struct(F.struct(F.col("amount").alias("Amount")).alias("BlendedCost")).alias("Metrics"),
    )
    per_day = per_service.groupBy("day").agg(F.collect_list(entry).alias("Groups"))
    period = F.struct(
        F.struct(F.col("day").cast("string").alias("Start")).alias("TimePeriod"),
        (F.col("day") >= F.to_date(F.lit(ESTIMATED_FROM))).alias("Estimated"),
        F.col("Groups"),
    )
    return per_day.select(F.to_json(F.struct(F.array(period).alias("ResultsByTime"))).alias("payload"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as job runs with start times in epoch milliseconds, rounded to the nearest, halves away from zero."""
    events = load(spark, sf_dir, "events")
    seconds = epoch_second(F.col("ts"), events.schema["ts"].dataType).cast("decimal(18,0)")
    exact = seconds * 1000 + F.expr("extract(SECOND FROM ts)") % 1 * 1000
    kind = F.col("event_type")
    name = F.when(kind == "purchase", F.lit("nightly purchase reconciliation for all regions"))
    name = name.when(kind == "signup", F.lit(None)).otherwise(kind)
    return events.select(
        F.col("user_id").alias("job_id"),
        name.alias("name"),
        F.round(exact).cast("bigint").alias("start_time"),
        F.when(kind != "error", F.lit("TERMINATED")).alias("status"),
    )


def starred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ISO-8601 texts to the second; every fiftieth has none."""
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return load(spark, sf_dir, "events").select(F.when(F.col("event_id") % 50 != 0, text).alias("starred_at"))


_GOLD_KEY_LIST = ", ".join(GOLD_KEYS)

# The same relations as SQL, in dependency order.
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "cust": (
        (),
        "SELECT c_custkey AS id, c_name AS name, n_name AS country"
        " FROM customer JOIN nation ON c_nationkey = n_nationkey",
    ),
    "prod": (
        (),
        "SELECT p_partkey AS product_id, p_name AS name, CAST(p_retailprice AS FLOAT) AS unit_price,"
        " CAST(p_partkey % 10 + 1 AS INTEGER) AS category_id,"
        " 'Category ' || CAST(p_partkey % 10 + 1 AS VARCHAR) AS category_name FROM part",
    ),
    "ord": (
        (),
        "SELECT o_orderkey AS id, o_custkey AS id_customer, CAST(o_totalprice AS FLOAT) AS total,"
        " strftime(o_orderdate, '%Y-%m-%d') AS date,"
        " o_orderkey % (SELECT count(*) FROM part) AS product_id FROM orders",
    ),
    "item": (
        (),
        "SELECT l_orderkey AS id_order, l_linenumber AS seq, 'Item_' || CAST(l_partkey AS VARCHAR) AS desc_item,"
        " CAST(l_quantity AS INTEGER) AS qty, CAST(l_extendedprice AS FLOAT) AS total_item FROM lineitem",
    ),
    "silver": (
        ("cust", "prod", "ord", "item"),
        "SELECT c.name AS customer_name, c.country, o.id_customer AS customer_id, i.id_order AS order_id,"
        " o.total AS order_total, CAST(o.date AS DATE) AS order_date, o.product_id, p.name AS product_name,"
        " p.category_id AS product_category_id, p.category_name, i.seq AS item_seq,"
        " i.desc_item AS item_description, i.qty AS item_quantity, i.total_item AS item_total"
        " FROM item i JOIN ord o ON i.id_order = o.id JOIN cust c ON o.id_customer = c.id"
        " JOIN prod p ON o.product_id = p.product_id",
    ),
    "gold_plain": (
        ("silver",),
        f"SELECT {_GOLD_KEY_LIST}, CAST(SUM(item_quantity) AS BIGINT) AS total_quantity,"
        " SUM(CAST(item_total AS DOUBLE)) AS total_value, COUNT(DISTINCT order_id) AS total_orders"
        f" FROM silver GROUP BY {_GOLD_KEY_LIST}",
    ),
    "frozen": (
        ("silver",),
        "SELECT * REPLACE (CASE WHEN product_id % 5 = 0 AND order_date >= DATE '1998-01-01'"
        " THEN product_name || '.1' ELSE product_name END AS product_name) FROM silver",
    ),
    "gold": (
        ("frozen",),
        f"SELECT {_GOLD_KEY_LIST}, CAST(SUM(item_quantity) AS BIGINT) AS total_quantity,"
        " SUM(CAST(item_total AS DOUBLE)) AS total_value, COUNT(DISTINCT order_id) AS total_orders"
        f" FROM frozen GROUP BY {_GOLD_KEY_LIST}",
    ),
    "latest": (
        ("gold",),
        "SELECT DISTINCT ON (product_id) product_id, product_name AS latest_name FROM gold"
        " ORDER BY product_id, order_date DESC, product_name DESC",
    ),
    "ds": (
        ("gold", "latest"),
        "SELECT latest_name AS product, product_name, customer_name AS customer, country, category_name AS category,"
        " order_date, SUM(total_value) AS total_value, CAST(SUM(total_orders) AS BIGINT) AS total_orders"
        " FROM gold JOIN latest USING (product_id)"
        " WHERE order_date >= DATE '1997-01-01' AND order_date < DATE '2001-01-01' GROUP BY ALL",
    ),
    "dirty": (
        ("ord",),
        "SELECT CASE WHEN id % 97 <> 0 THEN id END AS id, id_customer, total, date, product_id"
        " FROM (SELECT * FROM ord UNION ALL SELECT * FROM ord WHERE id % 101 = 0)",
    ),
    "checked": (
        ("dirty",),
        "SELECT *, COALESCE(total > 450000, FALSE) AS over_limit, id IS NULL AS no_id,"
        " id_customer IS NULL AS no_customer,"
        " id IS NOT NULL AND COUNT(*) OVER (PARTITION BY id) > 1 AS repeated FROM dirty",
    ),
    "usage": (
        (),
        "SELECT CAST(ts AS DATE) AS usage_date, ts AS usage_end_time,"
        " 'PREMIUM_' || upper(event_type) || '_COMPUTE_US_EAST_OHIO' AS sku_name,"
        " CASE WHEN event_type IN ('click', 'purchase') THEN 'AWS' ELSE 'AZURE' END AS cloud,"
        " CAST(value AS DECIMAL(18,4)) AS usage_quantity,"
        " CASE WHEN event_type IN ('click', 'view') THEN 'DBU' WHEN event_type = 'error' THEN 'DSU'"
        " WHEN event_type = 'purchase' THEN 'GB' END AS usage_unit,"
        " CASE WHEN user_id % 3 = 0 THEN CAST(user_id AS VARCHAR) END AS job_id,"
        " CASE WHEN user_id % 3 = 0 AND user_id % 2 = 0 THEN 'job_' || CAST(user_id % 7 AS VARCHAR) END AS job_name,"
        " CASE WHEN user_id % 3 = 0 THEN 'run_' || CAST(event_id % 50 AS VARCHAR) END AS job_run_id,"
        " CASE WHEN user_id % 3 = 1 THEN CAST(user_id AS VARCHAR) END AS dlt_pipeline_id FROM events",
    ),
    "prices": (
        (),
        "SELECT 'PREMIUM_' || upper(event_type) || '_COMPUTE_US_EAST_OHIO' AS sku_name,"
        " CASE WHEN event_type IN ('click', 'purchase') THEN 'AWS' ELSE 'AZURE' END AS cloud,"
        " CASE WHEN version = 1 THEN TIMESTAMP '2023-01-01 00:00:00' ELSE TIMESTAMP '2024-01-15 00:00:00' END"
        " AS price_start_time,"
        " CASE WHEN version = 1 THEN TIMESTAMP '2024-01-15 00:00:00' END AS price_end_time,"
        " CAST(CAST(length(event_type) * 5 + version AS DECIMAL(18,6)) / 100 AS DECIMAL(18,6)) AS list_price,"
        " CAST(CAST((length(event_type) * 5 + version) * 9 AS DECIMAL(18,6)) / 1000 AS DECIMAL(18,6)) AS effective_price"
        " FROM (SELECT DISTINCT event_type FROM events WHERE event_type <> 'signup') CROSS JOIN"
        " (SELECT unnest([1, 2]) AS version)",
    ),
    "pipes": (
        (),
        "SELECT CAST(user_id AS VARCHAR) AS pipeline_id,"
        " 'pipe_' || CAST(user_id % 7 AS VARCHAR) || '_v' || CAST(revision AS VARCHAR) AS name,"
        " CASE WHEN revision = 1 THEN TIMESTAMP '2023-06-01 00:00:00' ELSE TIMESTAMP '2024-01-10 00:00:00' END"
        " AS change_time FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 3 = 1) CROSS JOIN"
        " (SELECT unnest([1, 2]) AS revision)",
    ),
    "pipe_names": (
        ("pipes",),
        "SELECT pipeline_id, arg_max(name, change_time) AS name FROM pipes GROUP BY pipeline_id",
    ),
    "priced": (
        ("usage", "prices"),
        "SELECT u.*, v.effective_price, v.sku_name IS NOT NULL AS priced FROM usage u LEFT JOIN prices v"
        " ON v.sku_name = u.sku_name AND v.price_start_time <= u.usage_end_time"
        " AND COALESCE(v.price_end_time, TIMESTAMP 'infinity') > u.usage_end_time",
    ),
    "windowed": (("priced",), "SELECT * FROM priced WHERE usage_date >= DATE '2024-01-31' - INTERVAL 21 DAY"),
    "entity": (
        ("windowed", "pipe_names"),
        "SELECT CASE WHEN job_name IS NOT NULL THEN job_name WHEN name IS NOT NULL THEN name ELSE '(unnamed)' END"
        " AS entity, CASE WHEN dlt_pipeline_id IS NULL THEN 'job' ELSE 'pipeline' END AS kind, usage_unit,"
        " COUNT(DISTINCT usage_date) AS active_days, SUM(usage_quantity) AS quantity,"
        " SUM(effective_price * usage_quantity) AS usd FROM windowed"
        " LEFT JOIN pipe_names ON pipeline_id = dlt_pipeline_id"
        " WHERE job_id IS NOT NULL OR dlt_pipeline_id IS NOT NULL GROUP BY ALL",
    ),
    "daily": (
        ("windowed",),
        "SELECT usage_date, sku_name, usage_unit, SUM(usage_quantity) AS total_quantity,"
        " SUM(usage_quantity * effective_price) AS usd,"
        " CAST(SUM(CASE WHEN NOT priced THEN 1 ELSE 0 END) AS BIGINT) AS unpriced_records"
        " FROM windowed GROUP BY 1, 2, 3",
    ),
    "rows_of_daily": (
        ("daily",),
        "SELECT usage_date, sku_name, total_quantity, COALESCE(usage_unit, '(none)') AS usage_unit, usd,"
        " strftime(date_trunc('week', usage_date), '%Y-%m-%d') AS week,"
        " regexp_replace(regexp_replace(sku_name, '^PREMIUM_', ''),"
        " '_(US|EU|AP|CA|SA|AF|ME)_[A-Z0-9_]+$', '') AS sku_short FROM daily",
    ),
    "cloud_cost": (
        (),
        "SELECT strftime(l_shipdate, '%Y-%m-%d') AS date,"
        " CASE l_returnflag WHEN 'A' THEN 'Amazon ' WHEN 'R' THEN 'AWS ' ELSE '' END || 'Flag ' || l_returnflag"
        " || l_linestatus AS service,"
        " CAST(SUM(CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 0"
        " ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS blended_cost_usd,"
        " strftime(l_shipdate, '%Y-%m-%d') >= '2001-10-01' AS estimated,"
        " strftime(date_trunc('week', CAST(l_shipdate AS DATE)), '%Y-%m-%d') AS week"
        " FROM lineitem GROUP BY ALL",
    ),
    "run_list": (
        (),
        "SELECT user_id AS job_id, CASE event_type WHEN 'purchase' THEN"
        " 'nightly purchase reconciliation for all regions' WHEN 'signup' THEN NULL ELSE event_type END AS name,"
        " epoch_ms(ts) AS start_time, CASE WHEN event_type <> 'error' THEN 'TERMINATED' END AS status FROM events",
    ),
    "day_runs": (
        ("run_list",),
        "SELECT job_id, CASE WHEN length(COALESCE(name, 'Unnamed')) > 38 THEN substr(name, 1, 35) || '...'"
        " ELSE COALESCE(name, 'Unnamed') END AS job_name, COALESCE(status, 'UNKNOWN') AS status,"
        " strftime(make_timestamp(start_time * 1000), '%Y-%m-%d %H:%M:%S') AS started_at FROM run_list"
        " WHERE start_time >= epoch_ms(TIMESTAMP '2024-01-12') AND start_time < epoch_ms(TIMESTAMP '2024-01-13')",
    ),
    "stars": (
        (),
        "SELECT date_trunc('second', ts) AS event_time FROM events WHERE event_id % 50 <> 0",
    ),
}


def sql(body: str, *needs: str) -> str:
    """``body`` preceded by the named relations and everything they build on."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for inner in CTES[name][0]:
            visit(inner)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    if not ordered:
        return body
    return "WITH " + ", ".join(f"{name} AS ({CTES[name][1]})" for name in ordered) + " " + body
