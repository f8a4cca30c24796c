"""Session settings and the shared scratch area.

Scratch data (staged slices, small materialised aggregates, stream checkpoints) is written under
the folder the cluster names in ``spark.checkpoint.dir``, so a lost executor never loses it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the plans count on. forceOptimizeSkewedJoin lets AQE split a hot join
# partition even where that costs one more exchange downstream.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

SCRATCH_DATABASE = "orderloom_scratch"


def tune(spark: SparkSession) -> SparkSession:
    """Turn on the adaptive settings for this session; everything else stays the caller's."""
    for key, value in ADAPTIVE.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``; on a local master without it, one in the warehouse."""
    context = spark.sparkContext
    shared = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/") + "/orderloom"
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + f"/orderloom-scratch-{context.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Drop what this package staged: databases and files under the scratch folder.

    Results that are still to be read from there are lost, so this is the last step of a session.
    """
    root = scratch_root(spark)
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    inside = files.makeQualified(place).toUri().getPath().rstrip("/") + "/"
    for database in spark.catalog.listDatabases():
        if inside in database.locationUri + "/":
            spark.sql(f"DROP DATABASE IF EXISTS `{database.name}` CASCADE")
    files.delete(place, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared scratch area and read it back.

    Cuts the lineage on reliable storage, and gives the optimiser the real size of the result, so
    a later join broadcasts it only when it is measured to be under the broadcast threshold.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, label: str = "stage") -> Iterator[DataFrame]:
    """``df`` written once to a scratch table that is dropped at the end of the block."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {SCRATCH_DATABASE} LOCATION '{scratch_root(spark)}/staged'")
    table = f"{SCRATCH_DATABASE}.{label}_{uuid.uuid4().hex}"
    try:
        df.write.saveAsTable(table)
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
