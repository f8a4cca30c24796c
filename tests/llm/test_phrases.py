import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from orderloom.llm import bitfilter, phrases, queries

SCHEMA = "doc_id long, text string, lang string, a int, phrase string, left string"


def frame(spark, rows):
    """Documents of (text, lang) with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(k, t, lang, 1, "x", "y") for k, (t, lang) in enumerate(rows)], SCHEMA)


def against_sql(spark, rows, tmp_path, found):
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        expected = con.execute(queries.ORACLE_SQL["op12_phrase_collocations"]).fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    return expected


def prose(draw, many, vocabulary=40):
    words = [f"w{k}" for k in range(vocabulary)] + ["New", "YORK", "City", "of", "é"]
    fixed = [["new", "york", "city"], ["Of", "of", "of"], ["w1", "w2"], ["ice", "cream", "cone"]]
    for _ in range(many):
        text = []
        for _ in range(draw.randrange(0, 60)):
            text += draw.choice(fixed) if draw.random() < 0.2 else [draw.choice(words)]
            if draw.random() < 0.15:
                text[-1] += draw.choice([".", ",", "!?", ";", ":\n", "\r", "\x0b"])
        yield draw.choice([" ", "  ", "\t"]).join(text)


def test_transform_extends_by_intervals():
    """Interval pairs of the two transforms hold the occurrences of a phrase, and what stands on both sides."""
    draw = np.random.default_rng(5)
    numbers = np.r_[0, draw.integers(0, 6, 3000), 0]
    forward, reverse = phrases.Transform.of(numbers, 3), phrases.Transform.of(numbers[::-1], 3)
    found = phrases.single_words(numbers)
    for size in (2, 3):
        found = phrases.extended(found, reverse)
        windows = [tuple(numbers[k : k + size]) for k in range(len(numbers) - size + 1)]
        expected = Counter(w for w in windows if 0 not in w)
        assert {tuple(x): c for x, c in zip(found.numbers.tolist(), found.count.tolist(), strict=True)} == expected
        left = phrases.neighboured(forward, found.forward, found.count)
        right = phrases.neighboured(reverse, found.backward, found.count)
        for k, words in enumerate(map(tuple, found.numbers.tolist())):
            at = [i for i, w in enumerate(windows) if w == words]
            assert left[k] == sum(numbers[i - 1] > 0 for i in at)
            assert right[k] == sum(numbers[i + size] > 0 for i in at)


def test_large_vocabulary_sorts_alike():
    numbers = np.r_[0, np.random.default_rng(1).integers(0, 50, 500), 0]
    plain = phrases.Transform.of(numbers, 3)
    wide = phrases.Transform.of(np.where(numbers > 0, numbers + (1 << 22), 0), 3)
    assert (np.where(plain.before > 0, plain.before + (1 << 22), 0) == wide.before).all()
    assert (plain.steps == wide.steps).all()


def test_filter_knows_every_pair(spark):
    hashes = phrases._word_hashes([f"w{k}".encode() for k in range(300)])
    keys = phrases._pair_keys("en", hashes[:-1], hashes[1:])
    made = bitfilter.build(spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "key long"))
    assert bitfilter.passes(made, keys).all()
    assert np.unpackbits(made).sum() == len({b for bits in bitfilter.places(keys) for b in bits.tolist()})
    assert not bitfilter.passes(made, phrases._pair_keys("de", hashes[:-1], hashes[1:])).any()
    assert not bitfilter.passes(made, phrases._pair_keys("en", hashes[1:], hashes[:-1])).any()


@pytest.mark.parametrize("shard_words", [1, 300, 1 << 21])
def test_equals_sql_however_cut_into_shards(spark, tmp_path, monkeypatch, shard_words):
    monkeypatch.setattr(phrases, "SHARD_WORDS", shard_words)
    draw = random.Random(9)
    rows = [(t, draw.choice(["en", "fr", None, "und"])) for t in prose(draw, 300)]
    found = phrases.collocations(frame(spark, rows).repartition(5))
    expected = against_sql(spark, rows, tmp_path, found)
    assert len(expected) > 20
    assert any(len(r[2].split()) == 3 for r in expected)


def test_odd_rows(spark, tmp_path):
    rows = [(None, "en"), ("", "en"), (None, None), (" \t\n ", "en"), (".,;:!?\n\r", "de"), ("long " * 3000, "en")]
    rows += [("same row of words", "en")] * 12 + [("x" * 50_000 + " y", "en")] * 10 + [("A b. a B", None)] * 5
    found = phrases.collocations(frame(spark, rows))
    expected = {r[2] for r in against_sql(spark, rows, tmp_path, found)}
    assert {"long long long", "same row of", "row of words", "a b", "x" * 50_000 + " y"} <= expected
    assert "same row" not in expected


def test_top_and_ties(spark):
    rows = [(f"a{k} b{k}. " * 10, "en") for k in range(50)]
    found = phrases.collocations(frame(spark, rows), top=7).orderBy("rank").collect()
    names = sorted(f"a{k} b{k}" for k in range(50))
    assert [(r["rank"], r.phrase, r.score) for r in found] == [(k + 1, names[k], 1000000) for k in range(7)]


def test_empty(spark):
    assert phrases.collocations(frame(spark, [])).count() == 0
    assert phrases.collocations(frame(spark, [("no phrase twice", "en")])).count() == 0


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
        expected = con.execute(queries.ORACLE_SQL["op12_phrase_collocations"]).fetchall()
    found = queries.op12_phrase_collocations(spark, sf_dir).collect()
    assert sorted(map(tuple, found)) == sorted(expected)
