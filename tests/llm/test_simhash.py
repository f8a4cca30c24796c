import random

import numpy as np
import pytest
import xxhash

from orderloom.llm import simhash
from tests.llm.conftest import ODD_ROWS


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).translate(
        {c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    """Brute force: the smallest id reachable over links of four bits or fewer."""
    parent = {k: k for k in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in prints}


def test_fingerprints():
    draw = random.Random(3)
    for _ in range(40):
        text = " ".join(draw.choice(["Ab", "É", "c d", "e", "F\n"]) for _ in range(draw.randint(0, 30)))
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_components_against_brute_force(spark, documents):
    draw = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(120):
        base = [draw.choice(words) for _ in range(draw.choice([3, 40, 300]))]
        for copy in range(draw.choice([1, 1, 2, 6])):
            text = list(base)
            for _ in range(copy % 4):
                text[draw.randrange(len(text))] = "changed"
            rows.append((1000 - len(rows) if k % 2 else 2000 + len(rows), " ".join(text)))
    got = {r.doc_id: r for r in simhash.near_duplicates(documents(rows)).collect()}
    prints = {k: plain_fingerprint(t) for k, t in rows}
    assert {k: r.fingerprint for k, r in got.items()} == {k: f"{v:016x}" for k, v in prints.items()}
    assert {k: r.component_id for k, r in got.items()} == groups(prints)


@pytest.mark.parametrize("depth", [1, 4, 7])
def test_no_pair_is_lost_between_shards(depth):
    rng = np.random.default_rng(depth)
    seeds = rng.integers(0, 2**63, 300).astype(np.uint64)
    flips = [np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, k).astype(np.uint64)) for k in rng.integers(1, 5, 900)]
    fps = np.unique(np.concatenate((seeds, np.repeat(seeds, 3) ^ np.asarray(flips, dtype=np.uint64))))
    met = set()
    for block in simhash.BLOCKS:
        index, leaf, home = simhash.build_tree(fps[::2], depth, block, simhash.BLOCK_RADIUS).route(fps)
        assert np.bincount(index[home], minlength=len(fps)).tolist() == [1] * len(fps)
        for shard in np.unique(leaf):
            mine, owners = index[leaf == shard], index[(leaf == shard) & home]
            near = simhash.distance(fps[mine][:, None], fps[owners][None, :]) <= 4
            met |= {tuple(sorted((int(mine[a]), int(owners[b])))) for a, b in zip(*np.nonzero(near), strict=True)}
    near = simhash.distance(fps[:, None], fps[None, :]) <= 4
    assert {(a, b) for a, b in zip(*map(np.ndarray.tolist, np.nonzero(near)), strict=True) if a < b} <= met


def test_chains_and_dense_clusters():
    chain = np.asarray([(1 << k) - 1 for k in range(0, 61, 4)], dtype=np.uint64)
    label = simhash.linked_within(chain, np.ones(len(chain), bool), step=2)
    assert set(label.tolist()) == {0}
    dense = np.arange(16, dtype=np.uint64)
    assert set(simhash.linked_within(dense, np.ones(16, bool)).tolist()) == {0}


@pytest.mark.parametrize("most_rows", [30, 1 << 20])
def test_an_oversized_shard_is_compared_in_blocks(spark, monkeypatch, most_rows):
    """Clusters within a few bits that no tree splits: pairs of blocks find the same components, in bounded tasks."""
    monkeypatch.setattr(simhash, "MOST_ROWS", most_rows)
    rng = np.random.default_rng(4)
    centers = rng.integers(0, 2**63, 4).astype(np.uint64)
    flips = np.asarray([np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, k, replace=False).astype(np.uint64)) for k in rng.integers(1, 7, 400)])
    fps = np.unique(np.concatenate([centers, np.repeat(centers, 100) ^ flips, rng.integers(0, 2**63, 100).astype(np.uint64)]))
    distinct = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "_fp long")
    edges = simhash.links(distinct, len(fps))
    found = {r.node: r.root for r in simhash.components(edges).collect()}
    expected = groups({int(x): int(x) for x in fps})

    def classes(root_of):
        made = {}
        for x in fps:
            made.setdefault(root_of(x), set()).add(int(x))
        return sorted(map(sorted, made.values()))

    assert classes(lambda x: found.get(int(x.view(np.int64)), int(x.view(np.int64)))) == classes(lambda x: expected[int(x)])
    routed = spark.createDataFrame([(1, int(x), True) for x in fps.view(np.int64)], "shard long, fp long, home boolean")
    sizes = [r["count"] for r in simhash._in_blocks(routed).groupBy("shard", "_i", "_j").count().collect()]
    assert max(sizes) <= max(60, most_rows) and (len(sizes) > 1) == (most_rows == 30)


def test_star_contraction(spark):
    path = [(k, k + 1) for k in range(40)] + [(100, 200 + k) for k in range(50)] + [(7, 7)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100} | {200 + k: 100 for k in range(50)}


def test_odd_rows(spark, documents):
    got = simhash.near_duplicates(documents(ODD_ROWS)).collect()
    assert len(got) == len(ODD_ROWS)
    zero = {r.doc_id: r.component_id for r in got if r.fingerprint == "0" * 16}
    assert zero == {1: 1, 2: 1, 3: 1, None: 1}
    assert simhash.near_duplicates(documents([])).count() == 0


def test_one_of_each_group_stays(spark, documents):
    text = " ".join(f"w{k}" for k in range(300))
    rows = [(9, text), (5, text + " end"), (5, "other words entirely here now"), (None, text), (None, "alone with no id"), (3, "solo words are unique"), (3, "solo words are unique")]
    kept = simhash.keep_one(documents(rows))
    assert kept.columns == ["doc_id", "text", "score", "_fp", "_spans", "length"]
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted(
        [(5, text + " end"), (5, "other words entirely here now"), (None, "alone with no id"), (3, "solo words are unique")],
        key=repr,
    )
