import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import quality
from tests.llm.conftest import ODD_ROWS

SF_DIR = "/root/testdata/sf0.01"


def test_label_model_finds_the_accuracies():
    """Votes drawn from known accuracies: EM recovers them without a single true label."""
    rng = np.random.default_rng(1)
    truth = rng.random(40_000) < 0.2
    right = np.asarray([0.95, 0.9, 0.8, 0.7, 0.9])
    votes = np.where(rng.random((len(truth), 5)) < right, truth[:, None], ~truth[:, None]).astype(int)
    votes[:, 4] = np.where(rng.random(len(truth)) < 0.5, 2, votes[:, 4])
    patterns, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = quality.fit_labels(patterns, counts.astype(float))
    assert abs(model.bad - 0.2) < 0.02
    for j in range(4):
        assert abs(model.votes[j, 1, 1] - right[j]) < 0.03
    posterior = model.posterior(patterns)[at.ravel()]
    assert ((posterior > 0.5) == truth).mean() > (votes[:, 0] == truth).mean()


def test_scorer_separates():
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(0, 5000, rng.integers(5, 200))) for _ in range(2400)]
    target = rng.random(2400) < 0.15
    rows = [np.append(r, 9000 + rng.integers(0, 5)) if t else r for r, t in zip(rows, target, strict=True)]
    scorer = quality.train(rows, target.astype(float))
    scores = np.asarray([scorer.score(r) for r in rows])
    assert ((scores > scorer.threshold) == target).mean() > 0.98


def test_held_out_labels(spark):
    """Models fitted with a half of the labels agree with the other half."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    kept = quality.classify(docs, labels.where("hash(doc_id) % 2 = 0"))
    got = kept.join(labels.where("hash(doc_id) % 2 <> 0"), "doc_id").select("_keep", "quality", "toxic").collect()
    clean = [r._keep for r in got if r.quality == 1 and r.toxic == 0]
    junk = [r._keep for r in got if r.quality == 0]
    toxic = [r._keep for r in got if r.toxic == 1]
    assert np.mean(clean) > 0.95
    assert np.mean(junk) < 0.1
    assert np.mean(toxic) < 0.35  # a few hundred labels name few of the words; more name nearly all


def test_rare_toxic_documents_train_the_scorer(spark, documents):
    """One document in a hundred is toxic: a uniform draw of 400 rows would hold few of them and miss most words."""
    draw = random.Random(6)
    rows, marks = [], []
    for k in range(6000):
        words = [f"w{draw.randrange(800)}" for _ in range(60)]
        if k % 100 == 7:
            words[10], words[40] = f"vile{k // 100 % 12}x", f"foul{k // 100 % 12}x"
        rows.append((k, " ".join(words)))
        marks.append((k, 1, int(k % 100 == 7)))
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    docs = documents(rows).repartition(8)
    models = quality.fit(docs, labels, training_rows=400)
    scored = docs.select("doc_id", quality.passing(quality.scores(docs["text"], models), models).alias("keep")).collect()
    assert np.mean([r.keep for r in scored if r.doc_id % 100 == 7]) < 0.1
    assert np.mean([r.keep for r in scored if r.doc_id % 100 != 7]) > 0.98


def test_every_text_is_scored_once(spark):
    """The verdict and the returned scores come from one evaluation of the scorers."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scored = quality.classify(docs, labels).where("_keep").selectExpr("doc_id", "_junk", "_toxic")
    for found in (scored, quality.kept(docs, labels)):
        assert found._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_models_do_not_depend_on_partitions(spark):
    """The same table dealt out otherwise, and read in another order, keeps the same documents."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    kept = [
        {r.doc_id for r in quality.kept(d, l).select("doc_id").collect()}
        for d, l in ((docs, labels), (docs.repartition(7, "text"), labels.orderBy(F.desc("doc_id"))))
    ]
    assert kept[0] == kept[1]


@pytest.mark.parametrize("with_labels", [False, True])
def test_odd_rows(spark, documents, with_labels):
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 0, None), (None, 0, 1), (77, 0, 1)], "doc_id long, quality int, toxic int"
    )
    draw = random.Random(4)
    rows = [(100 + k, " ".join(f"w{draw.randrange(300)}" for _ in range(80))) for k in range(80)]
    docs = documents([*ODD_ROWS, *rows])
    scored = quality.classify(docs, labels if with_labels else None).collect()
    assert len(scored) == len(ODD_ROWS) + 80
    assert all(r._keep is not None and 0 <= r._junk <= 1 and 0 <= r._toxic <= 1 for r in scored)
    assert sum(r._keep for r in scored if (r.doc_id or 0) >= 100) >= 76
    assert quality.kept(docs, None).columns == docs.columns


def test_empty(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.classify(documents([]), labels).count() == 0
