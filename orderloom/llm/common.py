"""Reading, staging and Arrow settings shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.session import materialize, tune

TOKENIZER_DIR = "/opt/tokenizers"

# Batches are bounded in bytes as well as rows, so a run of very long texts cannot fill a Python worker.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Adaptive execution and byte-bounded Arrow batches for this session."""
    tune(spark)
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged_once(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder: no lineage behind it, nothing on one executor."""
    return materialize(df, f"llm-{label}")


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))
