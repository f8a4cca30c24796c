import hashlib
import random
from zlib import crc32

import numpy as np
import pytest

from orderloom.llm import queries, runs
from tests.llm.conftest import ODD_ROWS

SF_DIR = "/root/testdata/sf0.001"


def plain_runs(words):
    """(start, length, period) of all runs, by comparing every word with those any period on."""
    n, found = len(words), {}
    for period in range(1, n // 4 + 1):
        i = 0
        while i + period < n:
            if words[i] != words[i + period]:
                i += 1
                continue
            j = i
            while j + period < n and words[j] == words[j + period]:
                j += 1
            if j + period - i >= max(6, 4 * period):
                found.setdefault((i, j + period), period)
            i = j
    return sorted((s, e - s, p) for (s, e), p in found.items())


def plain_collapsed(words, found):
    dropped = {k for s, n, p in found for k in range(s + p, s + n)}
    return [w for k, w in enumerate(words) if k not in dropped]


def woven(draw):
    """Words with repetitions inside repetitions, of periods around the powers of two."""
    words = []
    while len(words) < draw.choice([3, 30, 200, 700]):
        if draw.random() < 0.6:
            period = draw.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 23, 31, 32, 33, 40, 63, 64, 70, 127, 128])
            unit = [draw.randrange(draw.choice([2, 3, 1000])) for _ in range(period)]
            if draw.random() < 0.3:
                inner = [draw.randrange(4) for _ in range(draw.randrange(1, 5))]
                unit = (inner * 130)[: period - 1] + [9]
            words += (unit * 8)[: draw.randrange(1, 7 * period)]
        else:
            words += [draw.randrange(draw.choice([2, 50])) for _ in range(draw.randrange(1, 40))]
        if draw.random() < 0.2:
            words += words[-draw.randrange(1, len(words) + 1) :]
    return words


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_brute_force(seed):
    draw = random.Random(seed)
    some = 0
    for _ in range(40):
        documents = [woven(draw) for _ in range(draw.randrange(1, 6))]
        got = runs.runs_of([np.asarray(d, dtype=np.int64) for d in documents])
        for words, found in zip(documents, got, strict=True):
            expected = plain_runs(words)
            some += len(expected)
            assert [tuple(r) for r in found.tolist()] == expected
    assert some > 100


def test_neighbouring_documents_do_not_join():
    repeated = np.tile(np.arange(10), 3)
    assert [len(r) for r in runs.runs_of([repeated] * 40)] == [0] * 40
    assert [len(r) for r in runs.runs_of([np.zeros(5, dtype=np.int64)] * 9)] == [0] * 9


def test_long_documents():
    """Constant, periodic and plain documents of many words, in time and memory that follow their length."""
    draw = np.random.default_rng(3)
    got = runs.runs_of(
        [np.zeros(400_000, dtype=np.int64), np.tile(np.arange(9_001), 40), draw.integers(0, 50_000, 400_000)]
    )
    assert got[0].tolist() == [[0, 400_000, 1]]
    assert got[1].tolist() == [[0, 9_001 * 40, 9_001]]
    assert got[2].tolist() == []


def expected_row(doc_id, text):
    words = (text or "").encode().split()
    words = [w.decode() for w in words]
    n = len(words)
    if doc_id is not None and n:
        h = crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    found = plain_runs(words)
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    listed = "".join(f"{s},{length},{p}\n" for s, length, p in found)
    kept = " ".join(plain_collapsed(words, found))
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)]
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *digests)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op13_periodic_runs(spark, SF_DIR).collect()
    assert sorted(map(tuple, got)) == sorted(expected_row(*d) for d in docs)
    assert sum(r.n_runs > 0 for r in got) > 5


def test_odd_rows(documents):
    rows = [*ODD_ROWS, (20, "a b a b a b a b a b"), (21, "\x1c  " * 8), (30, "x y\n" * 9)]
    got = runs.find_runs(documents(rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[1].runs == [] and by_id[1].collapsed == by_id[2].collapsed == by_id[3].collapsed == ""
    assert by_id[6].collapsed == "long" and [tuple(r) for r in by_id[6].runs] == [(0, 30_000, 1)]
    assert by_id[20].collapsed == "a b" and [tuple(r) for r in by_id[20].runs] == [(0, 10, 2)]
    assert by_id[21].collapsed == "\x1c "  # words end at ASCII white space only
    assert by_id[30].collapsed == "x y"


def test_empty(documents):
    assert runs.find_runs(documents([])).count() == 0
