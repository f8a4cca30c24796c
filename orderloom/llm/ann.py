"""Approximate nearest neighbours by inner product through a hierarchical k-means tree.

The tree is fitted on a bounded sample and every row is indexed in the leaf it descends to. A query walks
the tree best bin first, through a priority queue, and visits as many leaves as calibration asks for: the
recall of a few calibration queries against brute force over all rows decides how wide it goes.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import prepare, staged_once

NEAREST = 20
BRANCHES = 8

#: Vectors the tree is fitted on: one row in ``SAMPLE_SHARE``, within these bounds, so that leaves stay at about
#: ``LEAF_SAMPLE * SAMPLE_SHARE`` rows until the upper bound is reached.
SAMPLE_SHARE = 64
SAMPLE_ROWS = (20_000, 200_000)
LEAF_SAMPLE = 64
#: Rows, and queries, that one task compares at once: a leaf with more of either is dealt to several.
CHUNK_ROWS = 4096
CHUNK_QUERIES = 2048

#: Calibration aims at this share of the true neighbours; what a search finds is a little above or below.
CALIBRATION_QUERIES = 256
RECALL = 0.95


@dataclass
class Tree:
    """Nodes in order of creation; leaves have no children and a number."""

    centers: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    def add(self, center: np.ndarray) -> int:
        self.centers.append(center)
        self.children.append([])
        self.leaf.append(-1)
        return len(self.centers) - 1

    def descend(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest center at every level."""
        leaf, waiting = np.zeros(len(vectors), np.int64), [(0, np.arange(len(vectors)))]
        while waiting:
            node, rows = waiting.pop()
            if not self.children[node]:
                leaf[rows] = self.leaf[node]
            elif len(rows):
                near = _nearest(vectors[rows], np.stack([self.centers[c] for c in self.children[node]]))
                waiting += [(c, rows[near == k]) for k, c in enumerate(self.children[node])]
        return leaf

    def best_bins(self, query: np.ndarray) -> Iterator[int]:
        """Leaves from the most promising on: the queue holds the largest inner product with a center first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                yield self.leaf[node]
            for child in self.children[node]:
                heapq.heappush(queue, (-float(query @ self.centers[child]), child))


def _nearest(vectors: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmin((centers**2).sum(axis=1) - 2 * vectors @ centers.T, axis=1)


def fit_tree(sample: np.ndarray, seed: int = 7) -> Tree:
    """Hierarchical k-means: nodes with more than ``LEAF_SAMPLE`` vectors are split ``BRANCHES`` ways."""
    rng, tree = np.random.default_rng(seed), Tree()
    waiting = [(tree.add(sample.mean(axis=0) if len(sample) else np.zeros(1)), sample)]
    while waiting:
        node, mine = waiting.pop()
        groups: list[np.ndarray] = []
        if len(mine) > LEAF_SAMPLE:
            centers = mine[rng.choice(len(mine), BRANCHES, replace=False)]
            for _ in range(8):
                near = _nearest(mine, centers)
                centers = np.stack([mine[near == k].mean(axis=0) if (near == k).any() else centers[k] for k in range(BRANCHES)])
            near = _nearest(mine, centers)
            groups = [mine[near == k] for k in range(BRANCHES) if (near == k).any()]
        if len(groups) > 1:
            tree.children[node] = [tree.add(g.mean(axis=0)) for g in groups]
            waiting += list(zip(tree.children[node], groups, strict=True))
        else:
            tree.leaf[node] = tree.leaves
            tree.leaves += 1
    return tree


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def inner_products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Of each query with the vector in the same row: in double precision, component after component, so that equal
    vectors score exactly alike."""
    total = np.zeros(len(queries))
    for k in range(queries.shape[1]):
        total += queries[:, k] * vectors[:, k]
    return total


def top(queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query's place, places of its nearest vectors, scores): ties go to the smaller id.

    A matrix product finds all that can be among the nearest, whatever the order in which it sums; only those are
    scored component after component.
    """
    order = np.argsort(ids, kind="stable")
    vectors, ids = vectors[order], ids[order]
    largest = np.sqrt((vectors**2).sum(axis=1).max(initial=0.0))
    for at in range(0, len(queries), 128):
        block = queries[at : at + 128]
        rough = block @ vectors.T
        rough[own[at : at + 128, None] == ids[None, :]] = -np.inf
        if len(vectors) > k:
            least = np.partition(rough, len(vectors) - k, axis=1)[:, len(vectors) - k]
            slack = 8 * (queries.shape[1] + 1) * np.finfo(float).eps * largest * np.sqrt((block**2).sum(axis=1))
            likely = rough >= (least - slack)[:, None]
        else:
            likely = np.ones(rough.shape, dtype=bool)
        row, column = np.nonzero(likely & (rough > -np.inf))
        scores = inner_products(block[row], vectors[column])
        ranked = np.lexsort((column, -scores, row))  # columns are in order of ids
        row, column, scores = row[ranked], column[ranked], scores[ranked]
        starts = np.searchsorted(row, np.arange(len(block) + 1))
        for q, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
            b = min(a + k, b)
            yield at + q, order[column[a:b]], scores[a:b]


def usable(vectors: DataFrame, queries: Column, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(_id, _vec, _asked) of vectors that take part, and their length: the most frequent one of the whole table."""
    vec = F.col(vector_col).cast("array<double>")
    fine = (
        F.col(id_col).isNotNull()
        & (F.size(vec) > 0)
        & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists(vec, lambda x: x != 0)
    )
    rows = vectors.where(fine).select(
        F.col(id_col).cast("long").alias("_id"), vec.alias("_vec"), F.coalesce(queries, F.lit(False)).alias("_asked")
    )
    sizes = rows.groupBy(F.size("_vec").alias("w")).count().orderBy(F.desc("count"), "w").first()
    width = sizes["w"] if sizes else 0
    return rows.where(F.size("_vec") == width), width


def _distinct_enough(rows: DataFrame, k: int) -> DataFrame:
    """Of equal vectors, the rows of the ``k`` + 1 smallest ids, at most ``k`` of each.

    Ties go to smaller ids, and a query passes over the rows of one id, its own: no other row can be among its ``k``
    nearest. Copies are counted first, which combines map-side, however often a vector occurs.
    """
    copies = rows.groupBy("_vec", "_id").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("_copies"))
    alike = Window.partitionBy(F.xxhash64("_vec"), "_vec").orderBy("_id")
    few = copies.withColumn("_n", F.row_number().over(alike)).where(F.col("_n") <= k + 1)
    return few.select("_id", "_vec", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_id", "_vec")


def _calibrate(indexed: DataFrame, tree: Tree, width: int, k: int, n: int) -> int:
    """Leaves to visit: the fewest with which calibration queries find ``RECALL`` of their true nearest."""
    part = min(1.0, 4 * CALIBRATION_QUERIES / max(1, n))
    some = indexed.where(F.pmod(F.xxhash64("_id", F.lit(13)), F.lit(1_000_000)) < max(1, int(part * 1_000_000)))
    rows = some.select("_id", "_vec").orderBy("_id").limit(CALIBRATION_QUERIES).collect()
    if not rows:
        return 1
    own, queries = np.asarray([r[0] for r in rows]), np.asarray([r[1] for r in rows])

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vecs, leaves = batch.column(0).to_numpy(), _matrix(batch.column(1), width), batch.column(2).to_numpy()
            found = [(q, ids[p], leaves[p], s) for q, p, s in top(queries, own, vecs, ids, k)]
            if found:
                place = np.concatenate([np.full(len(f[1]), f[0]) for f in found])
                rest = [np.concatenate([f[i] for f in found]) for i in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (place, *rest)], names=["q", "id", "leaf", "score"])

    partial = indexed.select("_id", "_vec", "_leaf").mapInArrow(nearest, "q long, id long, leaf long, score double")
    ranked = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    truth = partial.withColumn("r", F.row_number().over(ranked)).where(F.col("r") <= k).select("q", "leaf").collect()
    orders = [{leaf: at for at, leaf in enumerate(tree.best_bins(q), 1)} for q in queries]
    needed = np.sort([orders[r["q"]][r["leaf"]] for r in truth])
    return int(needed[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))) - 1)]) if len(needed) else 1


def search(
    vectors: DataFrame,
    queries: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = NEAREST,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row that ``queries`` selects.

    Candidates are all rows but those with the query's id. Null ids, and vectors that are null, zero, of another
    length than most of the table or hold null or non-finite components, take no part, as queries neither. Repeated rows are candidates
    each, and a repeated query is answered once. Fewer than ``k`` candidates are all returned. An empty
    table gives an empty result; other columns are not read.
    """
    prepare(vectors.sparkSession)
    rows, width = usable(vectors, queries, id_col, vector_col)
    kept = staged_once(_distinct_enough(rows, k), "vectors")
    asked = rows.where("_asked").select("_id", "_vec").dropDuplicates(["_id"])  # dealt out by id
    asked = staged_once(asked.repartition(F.xxhash64("_id")), "queries")
    n = kept.count()
    least, most = SAMPLE_ROWS
    wanted = min(most, max(least, n // SAMPLE_SHARE))
    part = min(1.0, wanted / max(1, n))
    sampled = kept.where(F.pmod(F.xxhash64("_id", F.lit(17)), F.lit(1_000_000)) < max(1, int(part * 1_000_000)))
    sample = _matrix(sampled.select("_vec").limit(2 * wanted).toArrow().column(0).combine_chunks(), max(1, width))
    tree = fit_tree(sample)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.descend(_matrix(batch.column(1), width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["_id", "_vec", "_leaf"])

    indexed = staged_once(kept.mapInArrow(assign, "_id long, _vec array<double>, _leaf long"), "vector-index")
    visits = _calibrate(indexed, tree, width, k, n)
    # a row for each leaf of the bounded tree
    held = {r["_leaf"]: r["count"] for r in indexed.groupBy("_leaf").count().collect()}

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, leaf = [], []
            for place, query in enumerate(_matrix(batch.column(1), width)):
                rows = 0
                for seen, bin_ in enumerate(tree.best_bins(query), 1):
                    rows += held.get(bin_, 0)
                    if bin_ in held:
                        owner.append(place)
                        leaf.append(bin_)
                    if seen >= visits and rows > 2 * k:
                        break
            own = batch.column(0).take(pa.array(owner, type=pa.int64()))
            yield pa.RecordBatch.from_arrays([own, pa.array(leaf, pa.int64())], names=["query", "leaf"])

    visited = staged_once(asked.mapInArrow(walk, "query long, leaf long"), "visited-leaves")
    met = {r["leaf"]: r["count"] for r in visited.groupBy("leaf").count().collect()}
    blocks = [(leaf, -(-held[leaf] // CHUNK_ROWS), -(-count // CHUNK_QUERIES)) for leaf, count in met.items()]
    sizes = vectors.sparkSession.createDataFrame(blocks, "leaf long, _row_chunks int, _query_chunks int")
    sizes = F.broadcast(sizes)  # a row for each leaf

    def chunk(id_: str, of: str, salt: int) -> Column:
        return F.pmod(F.hash(id_, F.lit(salt)), F.col(of)).alias(of.replace("chunks", "chunk"))

    def every(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(of) - 1)).alias(of.replace("chunks", "chunk"))

    # blocks of queries against blocks of rows, so that no leaf is one task, however many rows or queries it has
    block = ("leaf", "_row_chunk", "_query_chunk")
    bins = visited.join(sizes, "leaf").select("query", "leaf", "_row_chunks", chunk("query", "_query_chunks", 23))
    bins = bins.join(asked.withColumnsRenamed({"_id": "query", "_vec": "qvec"}), "query")
    bins = bins.select("query", "qvec", "leaf", "_query_chunk", every("_row_chunks"))
    filed = indexed.join(sizes, F.col("_leaf") == F.col("leaf"))
    filed = filed.select("leaf", "_id", "_vec", "_query_chunks", chunk("_id", "_row_chunks", 19))
    filed = filed.select("leaf", "_id", "_vec", "_row_chunk", every("_query_chunks"))

    def compare(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = [np.zeros((0,)) for _ in range(3)]
        if len(left) and len(right):
            own, ids = left["query"].to_numpy(), right["_id"].to_numpy()
            made = list(top(np.stack(left["qvec"]), own, np.stack(right["_vec"]), ids, k))
            found = [
                np.concatenate([np.full(len(p), own[q]) for q, p, _ in made]),
                np.concatenate([ids[p] for _, p, _ in made]),
                np.concatenate([s for _, _, s in made]),
            ]
        return pd.DataFrame(
            {"query_id": found[0].astype(np.int64), "vec_id": found[1].astype(np.int64), "score": found[2].astype(float)}
        )

    near = bins.groupBy(*block).cogroup(filed.groupBy(*block)).applyInPandas(compare, "query_id long, vec_id long, score double")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = near.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def recall(found: DataFrame, vectors: DataFrame, queries: Column, k: int = NEAREST) -> float:
    """Share of true nearest neighbours found: brute force on Spark, the query set in blocks against all rows."""
    rows, width = usable(vectors, queries, "vec_id", "embedding")
    asked = rows.where("_asked").select("_id", "_vec").dropDuplicates(["_id"]).toArrow()
    rows = rows.select("_id", "_vec")
    own, matrix = asked.column("_id").to_numpy(), _matrix(asked.column("_vec").combine_chunks(), width)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            made = list(top(matrix, own, _matrix(batch.column(1), width), ids, k))
            cols = [np.concatenate([np.full(len(p), own[q]) for q, p, _ in made])]
            cols += [np.concatenate([ids[p] for _, p, _ in made]), np.concatenate([s for _, _, s in made])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["query_id", "vec_id", "score"])

    partial = rows.mapInArrow(nearest, "query_id long, vec_id long, score double")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    truth = partial.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    total = truth.count()
    return truth.join(found, ["query_id", "vec_id"], "left_semi").count() / total if total else 1.0
