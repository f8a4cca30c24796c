import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import ann

SF_DIR = "/root/testdata/sf0.01"


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS _leaf", "'a' AS rank")


def plain(rows, k):
    fine = [(i, np.asarray(v, dtype=np.float32).astype(float)) for i, v in rows]
    made = {}
    for q, v in fine:
        if q % 20 == 0:
            near = sorted(((-float((v * w).cumsum()[-1]), i) for i, w in fine if i != q))[:k]
            made[q] = [i for _, i in near]
    return made


def test_recall_on_given_vectors(spark):
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    found = ann.search(vectors, F.col("vec_id") % 20 == 0).cache()
    assert ann.recall(found, vectors, F.col("vec_id") % 20 == 0) >= 0.9
    ranks = found.groupBy("query_id").agg(F.collect_set("rank").alias("r")).collect()
    assert all(sorted(r.r) == list(range(1, 21)) for r in ranks)


def test_small_tables_are_searched_whole(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(size=6).tolist()) for k in range(41)]
    rows += [(100 + k, rows[7][1]) for k in range(60)]  # many equal vectors: ties by id
    rows += [(200, rows[7][1])]
    got = {}
    for r in ann.search(frame(spark, rows), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == plain(rows, 20)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [1.0, nan]), (5, [inf, 1.0])]
    rows += [(6, [1.0, None]), (7, []), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (20, None), (1, [0.5, 0.5])]
    got = ann.search(frame(spark, rows), F.col("vec_id") % 20 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == [(0, 1, 1, 0.5), (0, 2, 1, 0.5)]
    assert ann.search(frame(spark, rows[2:4]), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.search(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("chunk", [50])
def test_large_leaves_in_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(ann, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(ann, "LEAF_SAMPLE", 10_000)  # one leaf: the search is exact
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=4).tolist()) for k in range(300)]
    got = {}
    for r in ann.search(frame(spark, rows), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == plain(rows, 20)


def made(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def by_sorting(rows, queries, k=ann.NEAREST):
    """(query_id, rank, vec_id) by sorting all rows of every query."""
    found = []
    asked = {}
    for i, v in rows:
        if i in queries:
            asked.setdefault(i, v)
    for q, v in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != q)
        found += [(q, rank, i) for rank, (_, i) in enumerate(scores[:k], 1)]
    return sorted(found)


def answered(found):
    return sorted((r["query_id"], r["rank"], r["vec_id"]) for r in found.collect())


def test_copies_of_one_id_leave_room_for_others(spark):
    """A query's own id fills the equal vectors with copies: its neighbours are the other ids."""
    rows = [(20, [1.0, 2.0])] * 25 + [(100 + k, [1.0, 2.0]) for k in range(38)] + [(40, [0.5, 1.0])]
    found = ann.search(made(spark, rows), F.col("vec_id") % 20 == 0)
    queries = {i for i, _ in rows if i % 20 == 0}
    assert answered(found) == by_sorting(rows, queries)
    assert [r for r in answered(found) if r[0] == 20] == [(20, k + 1, 100 + k) for k in range(20)]


def test_common_length_is_that_of_the_table(spark):
    """Queries of another length neither answer nor decide which length counts."""
    rows = [(k, [1.0, float(k)]) for k in range(1, 20)] + [(20, [1.0, 1.0, 1.0]), (40, [1.0, 2.0, 3.0]), (60, [1.0, 2.0])]
    found = ann.search(made(spark, rows), F.col("vec_id") % 20 == 0)
    usable = [r for r in rows if len(r[1]) == 2]
    assert answered(found) == by_sorting(usable, {60})
    assert len(answered(found)) == 19


@pytest.mark.parametrize("chunk", [7, 4096])
def test_a_hot_leaf_is_dealt_to_many_tasks(spark, monkeypatch, chunk):
    """Near-equal vectors share a leaf, in which all queries meet them: blocks of both sides, the same result."""
    monkeypatch.setattr(ann, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(ann, "CHUNK_QUERIES", max(3, chunk // 2))
    rng = np.random.default_rng(8)
    rows = [(k, [1.0 + float(x) for x in rng.normal(scale=1e-6, size=4)]) for k in range(300)]
    found = ann.search(made(spark, rows), F.col("vec_id") % 20 == 0)
    assert answered(found) == by_sorting(rows, set(range(0, 300, 20)))


def test_top_equals_sorting_all_scores():
    """Many ties and near-ties, whose order a matrix product alone would not decide."""
    rng = np.random.default_rng(9)
    vectors = np.round(rng.normal(size=(400, 6)), 1)
    vectors[200:] = vectors[:200]
    ids = rng.permutation(400)
    queries, own = vectors[:50], ids[:50]
    for place, near, scores in ann.top(queries, own, vectors, ids, 20):
        all_scores = ann.inner_products(np.repeat(queries[place][None], 400, axis=0), vectors)
        expected = [j for j in np.lexsort((ids, -all_scores)) if ids[j] != own[place]][:20]
        assert near.tolist() == expected and scores.tolist() == all_scores[expected].tolist()
