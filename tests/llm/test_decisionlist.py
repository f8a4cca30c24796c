import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import decisionlist, queries
from tests.llm.conftest import ODD_ROWS

SF_DIR = "/root/testdata/sf0.01"


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    many = Counter(windows)
    repeated = {k + j for k, w in enumerate(windows) if many[w] > 1 for j in range(3)}
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(repeated),
        n < 50 or 100 * len(repeated) > 50 * n,
    )


def test_counts_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = queries.op11_decision_list(spark, SF_DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_counts(
            texts[r.doc_id]
        )
        assert r.kept == (not r.base_failed and r.rule is None)


def test_held_out_labels(spark):
    """A list learned from half of the labels agrees with the other half; here each half has hundreds of bad rows."""
    sf_dir = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rules = decisionlist.fit(docs, labels.where("hash(doc_id) % 2 = 0"))
    assert 1 <= len(rules.rules) <= 6, str(rules)
    got = decisionlist.judge(docs, rules).join(labels.where("hash(doc_id) % 2 <> 0"), "doc_id").collect()
    junk = [r.kept for r in got if r.quality == 0]
    clean = [r.kept for r in got if r.quality == 1 and not r.base_failed]
    assert np.mean(junk) < 0.05
    assert np.mean(clean) > 0.97


def planted(draw, many):
    """Rows that are bad if short in distinct words, or rich in symbols but for long ones; one in fifty is mislabelled."""
    x = draw.random((many, len(decisionlist.FEATURES)))
    x[:, 0] = draw.integers(1, 5000, many)
    at = decisionlist.FEATURES.index
    bad = (x[:, at("distinct_share")] < 0.2) | ((x[:, at("symbol_share")] > 0.8) & (x[:, 0] < 2500))
    return x, bad, bad ^ (draw.random(many) < 0.02)


def test_learns_planted_conjunctions():
    x, bad, said = planted(np.random.default_rng(4), 6000)
    rules = decisionlist.learn(x, said, np.arange(6000) % 3 == 0)
    fresh, truth, _ = planted(np.random.default_rng(5), 6000)
    assert (rules.rejects(fresh) == truth).mean() > 0.98
    assert len(rules.rules) <= 5, str(rules)
    assert any(len(r.conditions) > 1 for r in rules.rules)


def test_learns_nothing_from_noise():
    draw = np.random.default_rng(6)
    x = draw.random((3000, len(decisionlist.FEATURES)))
    assert decisionlist.learn(x, draw.random(3000) < 0.3, np.arange(3000) % 3 == 0).rules == ()


def test_expression_equals_the_list(spark, documents):
    """The Spark expression names the first rule that holds."""
    rules = decisionlist.DecisionList(
        tuple(
            decisionlist.Rule(tuple(decisionlist.Condition(*c) for c in conditions))
            for conditions in (
                [("symbol_share", True, 0.2), ("n_words", False, 100)],
                [("distinct_share", False, 0.5)],
                [("symbol_share", True, 0.1)],
            )
        )
    )
    texts = ["#### " * 60 + "a", "#### a b c", "d#e#f#g# " + " ".join(map(str, range(60))), " ".join(map(str, range(60))), "ab#cdefg"]
    docs = decisionlist.with_statistics(documents(list(enumerate(texts))), "text", "s")
    x = np.asarray([[r.s[c] for c in decisionlist.FEATURES] for r in docs.orderBy("doc_id").collect()], dtype=float)
    fired = [r[0] for r in docs.orderBy("doc_id").select(rules.fired(F.col("s"))).collect()]
    for row, number in zip(x, fired, strict=True):
        holding = [k + 1 for k, rule in enumerate(rules.rules) if rule.holds(row[None])[0]]
        assert number == (holding[0] if holding else None)
    assert fired[0] in (1, 2) and fired[3] is None and fired[4] == 3


@pytest.mark.parametrize("partitions", [1, 7])
def test_list_does_not_depend_on_partitions(spark, partitions):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(partitions)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    again = decisionlist.fit(docs.repartition(3), labels.repartition(5), labelled_rows=150)
    assert decisionlist.fit(docs, labels, labelled_rows=150) == again


@pytest.mark.parametrize("with_labels", [False, True])
def test_odd_rows(spark, documents, with_labels):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 0), (77, 0), (4, None)], "doc_id long, quality int")
    docs = documents([*ODD_ROWS, (8, "a\n\n a\na\n b")])
    rules = decisionlist.fit(docs, labels if with_labels else None)
    got = decisionlist.judge(docs, rules).collect()
    assert len(got) == len(ODD_ROWS) + 1
    expected = sorted(plain_counts(t) for _, t in [*ODD_ROWS, (8, "a\n\n a\na\n b")])
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == expected
    assert decisionlist.kept(docs, rules).columns == docs.columns


def test_empty(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    docs = documents([])
    assert decisionlist.judge(docs, decisionlist.fit(docs, labels)).count() == 0
