import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession

import golden
from orderloom import schemas
from orderloom.session import clear_scratch, scratch_path, tune
from orderloom.sources.tables import Lake


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("orderloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    clear_scratch(session)
    session.stop()


@pytest.fixture
def lake(spark):
    prefix = f"t{uuid.uuid4().hex[:10]}_"
    return Lake(spark, prefix).create(scratch_path(spark, "lake"))


@pytest.fixture
def shop(spark):
    """Customers, orders, lines and products of the small enrichment example."""
    customer = spark.createDataFrame(golden.CUSTOMERS, schemas.customer_schema())
    order = spark.createDataFrame(golden.ORDERS, schemas.order_schema())
    items = spark.createDataFrame(golden.ITEMS, schemas.order_item_schema())
    product = spark.createDataFrame(golden.PRODUCTS, schemas.product_schema())
    return customer, order, items, product


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
