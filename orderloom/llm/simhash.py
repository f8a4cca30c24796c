"""Near-duplicate groups: SimHash fingerprints matched exactly through vantage-point trees.

Two fingerprints within four bits agree to within one bit on one of three bit blocks at least. So there
is one vantage-point tree for each block, over the Hamming distance on that block, with search radius
one: a small radius is what lets the triangle bounds prune. The trees are built on a bounded sample of
fingerprints; that only shapes the shards. Every fingerprint goes to its home shard in each tree and, as
a query, to the shards its ball overlaps across a boundary, and shards check the full distance exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import prepare, staged_once

SHINGLE_WORDS = 4
SEED = 42
MOST_BITS = 4

#: Bits of each block; with three blocks, four differing bits leave one with a single one at most.
BLOCKS = tuple(np.uint64(((1 << width) - 1) << low) for low, width in ((0, 22), (22, 21), (43, 21)))
BLOCK_RADIUS = MOST_BITS // len(BLOCKS)

#: Fingerprints a shard should hold, and the bound on the sample that shapes the trees.
SHARD_ROWS = 2048
SAMPLE_ROWS = 20_000
#: Fingerprints that one task compares with each other at most; a larger shard is dealt to pairs of blocks.
MOST_ROWS = 16 * SHARD_ROWS
#: Edges of components in one file of a round.
FILE_EDGES = 2048


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of the word shingles of a whole text, repeats included; 0 without words."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # on bytes: A-Z only, and ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle_words:
        starts, ends = starts[: 1 - shingle_words], ends[shingle_words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    over = np.zeros(64, np.int64)
    for at in range(0, len(starts), 65_536):
        cut = zip(starts[at : at + 65_536].tolist(), ends[at : at + 65_536].tolist(), strict=True)
        hashes = np.asarray([xxh64_intdigest(joined[s:e], SEED) for s, e in cut], dtype="<u8")
        over += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * over > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``_text`` (a hash of the text) and ``_fp`` (the fingerprint's 64 bits as a long) of every row.

    A null text has no words.
    """
    prepare(docs.sparkSession)
    out = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("_text", T.LongType()),
            T.StructField("_fp", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            made = np.asarray([fingerprint(x or b"") for x in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made)], names=out.fieldNames())

    read = docs.select(id_col, F.xxhash64(text_col).alias("_text"), F.col(text_col).alias("_whole"))
    return read.mapInArrow(run, out)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


@dataclass(frozen=True)
class Tree:
    """A vantage-point tree on one block. Node i has children 2i + 1 (within the radius) and 2i + 2."""

    block: np.uint64
    radius: int
    point: np.ndarray
    split: np.ndarray  # -1: a leaf

    def route(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index into ``fps``, leaf, and whether that is its home, for every shard a fingerprint goes to.

        A pair within the radius meets in the home leaf of its outer fingerprint or of either: only
        fingerprints inside a boundary are sent across it, and what was sent visits every side its ball
        reaches, so no pair is missed and few are met twice.
        """
        inside = fps & self.block
        index, node, home = np.arange(len(fps)), np.zeros(len(fps), np.int64), np.ones(len(fps), bool)
        done: list[tuple[np.ndarray, ...]] = []
        while len(index):
            leaf = self.split[node] < 0
            done.append((index[leaf], node[leaf], home[leaf]))
            index, node, home = index[~leaf], node[~leaf], home[~leaf]
            far, split = distance(inside[index], self.point[node]).astype(np.int64), self.split[node]
            near = far <= split
            to_near = near | ~home & (far <= split + self.radius)
            to_far = far > split - self.radius
            index, node, home = (
                np.concatenate((index[to_near], index[to_far])),
                np.concatenate((2 * node[to_near] + 1, 2 * node[to_far] + 2)),
                np.concatenate((home[to_near], (home & ~near)[to_far])),
            )
        return tuple(np.concatenate(x) for x in zip(*done, strict=True))


def build_tree(sample: np.ndarray, depth: int, block: np.uint64, radius: int) -> Tree:
    """``depth`` levels; each node's point and split are those with the thinnest boundary among a few."""
    size = 2 ** (depth + 1) - 1
    point, split = np.zeros(size, np.uint64), np.full(size, -1, np.int64)
    held = {0: np.unique(sample & block)}
    for node in range(2**depth - 1):
        mine = held.pop(node, np.zeros(0, np.uint64))
        if len(mine) < 8:
            continue
        best = None
        for candidate in mine[:: max(1, len(mine) // 8)]:
            counts = np.bincount(distance(mine, candidate), minlength=66) / len(mine)
            below = np.cumsum(counts)
            for at in range(65):
                if 0.25 <= below[at] <= 0.75:
                    boundary = counts[max(0, at - radius + 1) : at + radius + 1].sum()
                    cost = boundary + abs(below[at] - 0.5) / 2
                    if best is None or cost < best[0]:
                        best = (cost, candidate, at)
        if best:
            point[node], split[node] = best[1:]
            near = distance(mine, point[node]) <= split[node]
            held[2 * node + 1], held[2 * node + 2] = mine[near], mine[~near]
    return Tree(block, radius, point, split)


def _roots(n: int, pairs: np.ndarray) -> np.ndarray:
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs.tolist():
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return np.asarray([find(x) for x in range(n)])


def linked_within(fps: np.ndarray, home: np.ndarray, most: int = MOST_BITS, step: int = 64) -> np.ndarray:
    """For each fingerprint of a shard, the place of the first one of its component.

    Every entry is compared with every home entry, a block at a time; pairs that are already connected
    are passed over, so a dense cluster costs comparisons but no list of its pairs.
    """
    label, homes = np.arange(len(fps)), np.flatnonzero(home)
    for at in range(0, len(fps), step):
        for low in range(0, len(homes), 32_768):
            cols = homes[low : low + 32_768]
            hit = distance(fps[at : at + step, None], fps[cols][None, :]) <= most
            hit &= label[at : at + step, None] != label[cols][None, :]
            rows, found = np.nonzero(hit)
            if len(rows):
                pairs = np.stack((label[at + rows], label[cols[found]]), axis=1)
                names, flat = np.unique(pairs, return_inverse=True)
                first = names[_roots(len(names), np.unique(flat.reshape(-1, 2), axis=0))]
                spot = np.searchsorted(names, label)
                spot[spot == len(names)] = 0
                label = np.where(names[spot] == label, first[spot], label)
    return label


def links(distinct: DataFrame, n: int, most: int = MOST_BITS) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints ``_fp`` that connect all that differ in few bits.

    Components of each shard come as stars: every link between two fingerprints is kept as a path.
    """
    spark = distinct.sparkSession
    depth = max(0, int(np.ceil(np.log2(max(1, n) / SHARD_ROWS))))
    part = min(1.0, 1.2 * SAMPLE_ROWS / max(1, n))
    shaping = distinct.where(F.pmod(F.xxhash64("_fp", F.lit(7)), F.lit(1_000_000)) < int(part * 1_000_000))
    sample = np.asarray([r[0] for r in shaping.limit(2 * SAMPLE_ROWS).collect()], dtype=np.int64).view(np.uint64)
    trees = [build_tree(sample, depth, block, BLOCK_RADIUS) for block in BLOCKS]
    width = 2 ** (depth + 1)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k, tree in enumerate(trees):
                index, leaf, home = tree.route(fps)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf + k * width), pa.array(fps[index].view(np.int64)), pa.array(home)],
                    names=["shard", "fp", "home"],
                )

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        fps = rows["fp"].to_numpy()
        order = np.argsort(fps, kind="stable")
        fps, home = fps[order], rows["home"].to_numpy()[order]
        label = linked_within(fps.view(np.uint64), home, most)
        tied = label != np.arange(len(fps))
        return pd.DataFrame({"a": fps[tied], "b": fps[label[tied]]})

    routed = staged_once(distinct.select("_fp").mapInArrow(route, "shard long, fp long, home boolean"), "shards")
    return _in_blocks(routed).groupBy("shard", "_i", "_j").applyInPandas(solve, "a long, b long").distinct()


def _in_blocks(routed: DataFrame) -> DataFrame:
    """Rows of shards with the pair (_i, _j) of blocks that a task compares: one pair, but for shards over ``MOST_ROWS``.

    A cluster that no tree can split is dealt to blocks, and every two blocks meet in a task of their own, so
    that no task holds more than two of them and every pair of the shard is compared in one.
    """
    sizes = routed.groupBy("shard").count().where(F.col("count") > MOST_ROWS)
    sizes = staged_once(sizes.select("shard", F.ceil(F.col("count") / (MOST_ROWS // 2)).cast("int").alias("_blocks")), "large-shards")
    dealt = routed.join(sizes, "shard", "left").withColumn("_mine", F.pmod(F.hash("fp", F.lit(31)), F.coalesce("_blocks", F.lit(1))))
    others = F.filter(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda b: b != F.col("_mine"))
    dealt = dealt.withColumn("_other", F.explode(F.when(F.col("_blocks").isNull(), F.array(F.lit(0))).otherwise(others)))
    return dealt.select("shard", "fp", "home", F.least("_mine", "_other").alias("_i"), F.greatest("_mine", "_other").alias("_j"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of the undirected edges (a, b).

    Alternating large and small stars; each round is written to the shared folder, in as many files as its edges are
    worth. Neighbourhoods are never gathered: a hub's minimum is a partial aggregate, joined back to its edges.
    """
    now = staged_once(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    most = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n, before = now.count(), None

    def written(star: DataFrame, label: str) -> DataFrame:
        return staged_once(star.coalesce(min(most, 1 + n // FILE_EDGES)), label)

    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hooked = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = written(least.select("a", F.col("m").alias("b")).union(hooked).distinct(), "small-star")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        n, before = state[0], state
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def grouped(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows' fingerprints, and (_fp, _least, _root) of every distinct one: its smallest id and component."""
    made = staged_once(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = staged_once(made.groupBy("_fp").agg(F.min(id_col).alias("_least")), "classes")
    roots = components(links(classes, classes.count()))
    rooted = classes.join(roots, classes["_fp"] == roots["node"], "left").select(
        "_fp", "_least", F.coalesce("root", "_fp").alias("_root")
    )
    return made, staged_once(rooted, "rooted")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, ``fingerprint`` (16 hex digits) and ``component_id``.

    Documents link at ``MOST_BITS`` or fewer differing bits; ``component_id`` is the smallest id
    reachable, the document's own included (null ids are passed over unless a component has no other).
    Null, empty and blank texts share fingerprint zero and link like any other. Repeated rows are each
    returned; other columns are not read; an empty table gives an empty result.
    """
    made, rooted = grouped(docs, id_col, text_col)
    named = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    named = rooted.join(named, "_root").select(F.col("_fp").alias("_of"), "component_id")
    return made.join(named, made["_fp"] == named["_of"]).select(
        id_col, F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one with the smallest id.

    All columns stay, of rows alike in id and text one. Ties of the id go by the text's hash; a row
    without an id stays only where its group has no row with one.
    """
    made, rooted = grouped(docs, id_col, text_col)
    order = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i"), F.col("_text").alias("t"))
    first = made.groupBy("_fp").agg(F.min(order).alias("_first"))
    best = first.join(rooted.select(F.col("_fp").alias("_of"), "_root"), F.col("_fp") == F.col("_of"))
    best = best.groupBy("_root").agg(F.min("_first").alias("_first"))
    best = best.select(
        F.xxhash64("_first.i", "_first.t").alias("__llm_k1"), F.xxhash64("_first.t", F.lit(1), "_first.i").alias("__llm_k2")
    )
    text = F.xxhash64(text_col)
    keyed = docs.withColumns(
        {"__llm_key1": F.xxhash64(F.col(id_col), text), "__llm_key2": F.xxhash64(text, F.lit(1), F.col(id_col))}
    )
    kept = keyed.join(best, (F.col("__llm_key1") == F.col("__llm_k1")) & (F.col("__llm_key2") == F.col("__llm_k2")), "left_semi")
    one = Window.partitionBy("__llm_key1", "__llm_key2").orderBy(F.lit(0))
    return kept.withColumn("__llm_copy", F.row_number().over(one)).where("__llm_copy = 1").drop("__llm_copy", "__llm_key1", "__llm_key2")
