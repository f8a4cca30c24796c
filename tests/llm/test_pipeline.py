import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from orderloom.llm import packing
from orderloom.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.conftest import ODD_ROWS

SF_DIR = "/root/testdata/sf0.001"


def test_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= names
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    got = QUERIES[name](spark, SF_DIR)
    found = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(found.fetchall())


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, SF_DIR).cache()
        assert after.columns == docs.columns
        assert after.join(kept, "doc_id", "left_anti").count() == 0
        kept = after
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert 0 < len(texts) < docs.count()
    assert any("[SECRET]" in t for t in texts.values())
    # the whole run packs just these texts, whole
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    wanted = set()
    for doc_id, text in texts.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        for at in range(0, len(ids), 2048):
            wanted.add((doc_id, at // 2048, zlib.crc32(np.asarray(ids[at : at + 2048], "<u4").tobytes())))
    got = {(r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert got == wanted


def test_odd_documents_pass_all_stages(spark):
    """Null ids and texts, very long and repeated rows, and columns named like inner ones, among the given documents."""
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame([(i, t, "en", "odd", 0) for i, t in ODD_ROWS], given.schema)
    clashing = ("_row", "_k1", "_spans", "score", "piece", "_draw", "key", "words")
    docs = given.unionByName(odd).withColumns({c: F.lit(c) for c in clashing})
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, SF_DIR).cache()
        assert after.columns == docs.columns
        assert after.filter(" OR ".join(f"{c} <> '{c}'" for c in clashing)).isEmpty()
        kept = after
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF_DIR)
    whole = packed.filter("piece = 0").groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in whole} == {r.doc_id: r["count"] for r in kept.groupBy("doc_id").count().collect()}
    assert kept.filter("text = 'same row'").count() == 1  # of two


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0
        if "text" not in docs.columns:
            break


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
