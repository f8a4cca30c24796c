"""Quality and toxicity classifier trained on weak labels.

Overlapping heuristic labellers vote on every document. Expectation-maximisation over the counts of
their vote patterns estimates how accurate each is, and gives every pattern a posterior. The posteriors
of a bounded sample train a hashed linear scorer, whose scores decide on every document.

There are two such models, one for unreadable text (``junk``) and one for toxic text (``toxic``): they
have different labellers, and a document is kept if neither scorer rejects it.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from operator import eq
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import prepare, staged_once

#: Bounds of the samples that models are fitted on: labelled rows for the mined word lists, and rows with
#: posteriors for the scorers, bad ones first. Corpus statistics (vote patterns) are counted over all documents.
MINING_ROWS = 20_000
TRAINING_ROWS = 8_000

DIMENSIONS = 1 << 18
STEM = 4
BAD, GOOD, ABSTAIN = 1, 0, 2
REMEMBERED_WORDS = 150_000


@dataclass(frozen=True)
class Shape:
    """Shares that describe how a text is written, each between 0 and 1."""

    marked: float  # words that end in a run of marks
    barred: float  # words that are a lone mark
    stuttered: float  # words equal to the one before
    repeated: float  # lines that stood before
    shouted: float  # words in capitals only
    varied: float  # different words among the first words
    n: int


_MARKS = "%&$#*!?=~^+@"


def shape(words: list[str], text: str) -> Shape:
    n = max(1, len(words))
    lines = [x for x in text.split("\n") if x]
    different = set(words)
    spaced = " ".join(words) + " "
    lone = [x for x in different if len(x) == 1 and not x.isalnum()]
    return Shape(
        sum(spaced.count(f"{a}{a} ") for a in _MARKS) / n,
        sum(map(words.count, lone)) / n if len(lone) < 50 else sum(x in lone for x in words) / n,
        sum(map(eq, words, words[1:])) / n,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        sum(map(str.isupper, words)) / n,
        len(different) / n,
        len(words),
    )


def junk_votes(s: Shape) -> list[int]:
    """One vote each of the labellers of readable text; overlapping on purpose."""
    strange = s.marked + s.barred + s.stuttered
    return [
        BAD if s.marked > 0.15 else ABSTAIN,
        BAD if s.barred > 0.1 else ABSTAIN,
        BAD if s.stuttered > 0.2 else ABSTAIN,
        BAD if strange > 0.15 else GOOD if strange < 0.03 else ABSTAIN,
        BAD if s.repeated > 0.5 and s.n > 30 else GOOD if s.repeated < 0.2 else ABSTAIN,
        BAD if s.shouted > 0.5 and s.n > 5 else ABSTAIN,
        BAD if s.n > 20 and s.varied < 0.1 else GOOD if s.n > 20 and s.varied > 0.4 else ABSTAIN,
    ]


_AROUND = string.punctuation + "«»“”„‘’‚…–—¿¡"


def bare(word: str) -> str:
    """The word without the marks around it."""
    return word.strip(_AROUND)


def terms(words: list[str]) -> set[str]:
    return {w for w in map(bare, set(words)) if w}


# ---- word lists mined from labelled rows ----------------------------------------------------------


@dataclass(frozen=True)
class WordLists:
    """Words (of one half of the labelled rows each) and stems that stand in toxic texts only."""

    first: frozenset[str]
    second: frozenset[str]
    stems: frozenset[str]


def mine(labelled: DataFrame) -> WordLists:
    """Word lists from rows (_key, _whole, _toxic): each half of the rows tells one list of words.

    Every task counts its rows' terms; the sums are compared on Spark and only telling words come back.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for key, text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = terms((text or "").lower().split()) | {""}  # the empty term counts rows
                half = key % 2
                seen.update((half, w, toxic) for w in found)
                seen.update((2, w, toxic) for w in {w[:STEM] for w in found if len(w) >= STEM or not w})
        keys = list(seen)
        for at in range(0, len(keys), 50_000):
            part = keys[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[i] for k in part], type=t) for i, t in enumerate((pa.int32(), pa.string(), pa.int32()))]
                + [pa.array([seen[k] for k in part], type=pa.int64())],
                names=["list", "term", "toxic", "n"],
            )

    counts = labelled.select("_key", "_whole", "_toxic").mapInArrow(count, "list int, term string, toxic int, n long")
    sums = counts.groupBy("list", "term").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("toxic") == 1, 0).otherwise(F.col("n"))).alias("good"),
    )
    sums = staged_once(sums, "term-counts")
    total = {r["list"]: (r["bad"], max(1, r["good"])) for r in sums.where("term = ''").collect()}
    lists: list[frozenset[str]] = []
    for k in range(3):
        bad, good = total.get(k, (0, 1))
        telling = sums.where(
            (F.col("list") == k)
            & (F.col("term") != "")
            & (F.col("bad") >= max(3, bad // 400))
            & (F.col("bad") / max(1, bad) > 50 * (F.col("good") + 0.2) / good)
        )
        lists.append(frozenset(r["term"] for r in telling.select("term").collect()))
    return WordLists(*lists)


def toxic_votes(words: list[str], lists: WordLists) -> list[int]:
    found = terms(words)
    return [
        BAD if found & lists.first else GOOD,
        BAD if found & lists.second else GOOD,
        BAD if {w[:STEM] for w in found if len(w) >= STEM} & lists.stems else GOOD,
        BAD if len(found & (lists.first | lists.second)) > 1 else ABSTAIN,
    ]


# ---- the label model ------------------------------------------------------------------------------


@dataclass(frozen=True)
class LabelModel:
    """P(bad) and, for each labeller, P(vote | class) as an array (labellers, classes, votes)."""

    bad: float
    votes: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """P(bad | votes) for each row of votes."""
        at = np.arange(patterns.shape[1])
        odds = np.log(self.votes[at, 1, patterns]).sum(axis=1) - np.log(self.votes[at, 0, patterns]).sum(axis=1)
        return 1 / (1 + np.exp(-(odds + np.log(self.bad) - np.log1p(-self.bad))))


def fit_labels(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> LabelModel:
    """Expectation-maximisation over vote patterns and how often each occurs."""
    cast = (patterns != ABSTAIN).sum(axis=1)
    post = ((patterns == BAD).sum(axis=1) + 0.1) / (cast + 0.4)
    is_vote = (patterns[:, :, None] == np.arange(3)).astype(float)
    for _ in range(rounds):
        weight = np.stack((counts * (1 - post), counts * post))
        votes = np.einsum("cp,plv->lcv", weight, is_vote) + 0.5
        votes /= votes.sum(axis=2, keepdims=True)
        bad = float(np.clip(weight[1].sum() / weight.sum(), 1e-4, 0.5))
        new = LabelModel(bad, votes).posterior(patterns)
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return LabelModel(bad, votes)


# ---- the hashed linear scorer ---------------------------------------------------------------------


def _slot(kind: str, value: str) -> int:
    return crc32(value.encode(), crc32(kind.encode())) % DIMENSIONS


def shape_slots(s: Shape) -> list[int]:
    """Hashed features of the shape: each share in coarse steps, and the length in powers of four."""
    steps = (0.03, 0.1, 0.2, 0.35, 0.5, 0.75)
    found = [_slot("length", str(max(0, s.n.bit_length() // 2)))]
    for name in ("marked", "barred", "stuttered", "repeated", "shouted", "varied"):
        found += [_slot(name, str(x)) for x in steps if getattr(s, name) > x]
    return found


_WORD, _STEM = crc32(b"word"), crc32(b"stem")


class WordSlots(dict):
    """Hashed features of a word: itself and its stem; with ``used``, those features alone."""

    def __init__(self, used: np.ndarray | None = None) -> None:
        super().__init__()
        self.used = used

    def __missing__(self, word: str) -> tuple[int, ...]:
        w = bare(word)
        made = ()
        if w:
            made = (crc32(w.encode(), _WORD) % DIMENSIONS,)
            if len(w) >= STEM:
                made = (*made, crc32(w[:STEM].encode(), _STEM) % DIMENSIONS)
            if self.used is not None:
                made = tuple(x for x in made if self.used[x])
        if len(word) <= 64:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            self[word] = made
        return made


def word_slots(words: list[str], memory: WordSlots) -> set[int]:
    return set(chain.from_iterable(filter(None, map(memory.__getitem__, set(words)))))


@dataclass(frozen=True)
class Scorer:
    """P(bad) is the logistic function of ``base`` and the weights of the features present."""

    base: float
    weights: np.ndarray
    threshold: float

    def score(self, slots: list[int]) -> float:
        return 1 / (1 + float(np.exp(-np.clip(self.base + self.weights[slots].sum(), -30, 30))))


def train(
    rows: list[np.ndarray],
    target: np.ndarray,
    penalty: float = 3e-4,
    rounds: int = 150,
    weight: np.ndarray | None = None,
) -> Scorer:
    """L1-penalised logistic regression on soft targets, by accelerated proximal gradient steps.

    A fifth of the rows is held out; the threshold is where scores of the held-out rows separate best.
    ``weight``: how many documents a row stands for. Weights of features are learnt from the rows as drawn;
    the base is moved to the true share of bad documents, and the threshold counts documents.
    """
    if not len(rows):
        return Scorer(-30.0, np.zeros(DIMENSIONS, np.float32), 0.5)
    used, packed = np.unique(np.concatenate(rows), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    held = np.arange(len(rows)) % 5 == 4
    learn = ~held if (~held).any() else held
    n = learn.sum()
    inside = learn[owner]
    rate = np.bincount(packed[inside], minlength=len(used))
    scale = 1 / np.sqrt(np.maximum(rate, 1) / n)  # rare features move as easily as frequent ones
    scale = np.minimum(scale, 12.0)
    w, v, base, momentum = np.zeros(len(used)), np.zeros(len(used)), 0.0, 1.0
    step = 4 / max(1.0, float(np.max(np.bincount(owner, weights=scale[packed] ** 2))) ** 0.5)

    def logits(u: np.ndarray, b: float) -> np.ndarray:
        return b + np.bincount(owner, weights=(u * scale)[packed], minlength=len(rows))

    for _ in range(rounds):
        error = np.where(learn, 1 / (1 + np.exp(-np.clip(logits(v, base), -30, 30))) - target, 0.0) / n
        slope = np.bincount(packed, weights=error[owner], minlength=len(used)) * scale
        new = v - step * slope
        new = np.sign(new) * np.maximum(0, np.abs(new) - step * penalty)
        base -= step * error.sum() * 4
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        v, w, momentum = new + (momentum - 1) / after * (new - w), new, after
    scores = 1 / (1 + np.exp(-np.clip(logits(w, base), -30, 30)))
    pick = held if held.any() else learn
    weight = np.ones(len(rows)) if weight is None else weight
    truth, mine_scores = target[pick] > 0.5, scores[pick]
    best, threshold = -1.0, 0.5
    for t in np.linspace(0.1, 0.9, 33):
        right = np.average((mine_scores > t) == truth, weights=weight[pick])
        gain = right - 0.0001 * abs(t - 0.5)
        if gain > best:
            best, threshold = gain, float(t)
    drawn, true = (np.clip(np.average(target, weights=x), 1e-6, 1 - 1e-6) for x in (None, weight))
    shift = float(np.log(true) - np.log1p(-true) - np.log(drawn) + np.log1p(-drawn))
    base, threshold = base + shift, 1 / (1 + (1 / threshold - 1) * float(np.exp(-shift)))
    weights = np.zeros(DIMENSIONS, np.float32)
    weights[used] = w * scale
    return Scorer(float(base), weights, threshold)


# ---- fitting and applying on Spark ----------------------------------------------------------------


@dataclass(frozen=True)
class Models:
    junk: Scorer
    toxic: Scorer
    lists: WordLists


def _voted(docs: DataFrame, lists: WordLists) -> DataFrame:
    """(_id, _key, _draw, votes as digits) of every row of (_id, _key, _draw, _whole)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes = []
            for text in batch.column(3).to_pylist():
                words, low = (text or "").split(), (text or "").lower().split()
                votes.append("".join(map(str, junk_votes(shape(words, text or "")) + toxic_votes(low, lists))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(votes, type=pa.string())], names=["_id", "_key", "_draw", "_votes"]
            )

    kind = docs.schema["_id"].dataType.simpleString()
    return docs.select("_id", "_key", "_draw", "_whole").mapInArrow(run, f"_id {kind}, _key long, _draw int, _votes string")


def _featured(rows: DataFrame) -> DataFrame:
    """(_pattern, _n, hashed features) of rows (_pattern, _n, _whole)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordSlots()
        for batch in batches:
            shapes, slots = [], []
            for text in batch.column(2).to_pylist():
                shapes.append(shape_slots(shape((text or "").split(), text or "")))
                slots.append(sorted(word_slots((text or "").lower().split(), memory)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *(pa.array(x, type=pa.list_(pa.int32())) for x in (shapes, slots))],
                names=["_pattern", "_n", "_shapes", "_slots"],
            )

    rows = rows.select("_pattern", "_n", "_whole")
    return rows.mapInArrow(run, "_pattern string, _n long, _shapes array<int>, _slots array<int>")


def draw_rates(classes: np.ndarray, many: np.ndarray, training_rows: int) -> np.ndarray:
    """Share of the documents to draw for each pattern: a quarter of the rows for each rare bad class, if it has so many.

    ``classes``: 2 for toxic, 1 for junk, 0 for other patterns; ``many``: how often each pattern occurs.
    """
    total = np.asarray([many[classes == c].sum() for c in range(3)])
    wanted = np.minimum(total, np.maximum(training_rows / 4, training_rows * total / max(1, total.sum())))
    wanted[0] = min(total[0], max(training_rows / 4, training_rows - wanted[1:].sum()))
    return np.minimum(1.0, wanted / np.maximum(1, total))[classes]


JUNK_LABELLERS, TOXIC_LABELLERS = 7, 4


def fit(
    docs: DataFrame,
    labels: DataFrame | None,
    id_col: str = "doc_id",
    text_col: str = "text",
    mining_rows: int = MINING_ROWS,
    training_rows: int = TRAINING_ROWS,
) -> Models:
    """Fit both models. ``labels`` (id, quality 0/1, toxic 0/1; null: no opinion) is one more labeller.

    Labels of a null id or of an unknown document have no effect; of repeated labels the worse counts.
    """
    spark = prepare(docs.sparkSession)
    if labels is None:
        labels = spark.createDataFrame([], f"{id_col} {docs.schema[id_col].dataType.simpleString()}, quality int, toxic int")
    labels = (
        labels.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_of"))
        .agg(F.min(F.col("quality").cast("int")).alias("_quality"), F.max(F.col("toxic").cast("int")).alias("_toxic"))
    )
    labels = staged_once(labels, "labels")
    part = min(1.0, mining_rows / max(1, labels.count()))
    sampled = labels.where(F.pmod(F.xxhash64("_of", F.lit(3)), F.lit(1_000_000)) < int(part * 1_000_000))
    sampled = sampled.where("_toxic in (0, 1)").orderBy(F.xxhash64("_of", F.lit(3)), "_of").limit(2 * mining_rows)
    # bounded, so it may go to every task
    whole = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_whole"))
    labelled = whole.join(F.broadcast(sampled), whole["_id"] == sampled["_of"]).select(
        F.pmod(F.xxhash64("_id", F.lit(5)), F.lit(1 << 20)).cast("int").alias("_key"), "_whole", "_toxic"
    )
    lists = mine(labelled)

    # by id and text, so that the draw does not depend on partitions; equal rows are one row that stands for all
    keyed = whole.withColumn("_key", F.xxhash64("_id", "_whole", F.lit(7)))
    place = F.pmod(F.xxhash64("_key", F.lit(11)), F.lit(1_000_000)).cast("int")
    voted = staged_once(_voted(keyed.withColumn("_draw", place), lists), "votes")
    opinion = F.concat(
        F.col("_votes"),
        F.when(F.col("_quality") == 0, "1").when(F.col("_quality") == 1, "0").otherwise("2"),
        F.when(F.col("_toxic") == 1, "1").when(F.col("_toxic") == 0, "0").otherwise("2"),
    )
    joined = voted.join(labels, voted["_id"] == labels["_of"], "left").withColumn("_pattern", opinion)
    counts = joined.groupBy("_pattern").count().collect()  # a row for each pattern of votes
    if not counts:
        return Models(train([], np.zeros(0)), train([], np.zeros(0)), lists)
    names = [r["_pattern"] for r in counts]
    patterns = np.asarray([[int(v) for v in x] for x in names])
    many = np.asarray([r["count"] for r in counts], dtype=float)
    junk_at = [*range(JUNK_LABELLERS), JUNK_LABELLERS + TOXIC_LABELLERS]
    toxic_at = [*range(JUNK_LABELLERS, JUNK_LABELLERS + TOXIC_LABELLERS), JUNK_LABELLERS + TOXIC_LABELLERS + 1]
    posteriors = [fit_labels(patterns[:, at], many).posterior(patterns[:, at]) for at in (junk_at, toxic_at)]
    junk, toxic = ((p > 0.5) | (patterns[:, at[-1]] == BAD) for p, at in zip(posteriors, (junk_at, toxic_at), strict=True))
    rates = draw_rates(np.where(toxic, 2, np.where(junk, 1, 0)), many, training_rows)

    least = spark.createDataFrame([(x, int(np.ceil(r * 1_000_000))) for x, r in zip(names, rates.tolist(), strict=True)], "_of_pattern string, _least int")
    drawn = joined.join(F.broadcast(least), F.col("_pattern") == F.col("_of_pattern")).where("_draw < _least")
    drawn = drawn.groupBy(F.col("_key").alias("_drawn")).agg(F.first("_pattern").alias("_pattern"), F.count("*").alias("_n"))
    drawn = staged_once(drawn.orderBy("_drawn").limit(2 * training_rows), "drawn")  # bounded, so it may go to every task
    texts = keyed.join(F.broadcast(drawn), F.col("_key") == F.col("_drawn")).groupBy("_key")
    texts = texts.agg(*[F.first(c).alias(c) for c in ("_pattern", "_n", "_whole")])
    rows = _featured(texts).toArrow()
    at = {x: k for k, x in enumerate(names)}
    cast = np.asarray([at[x] for x in rows.column(0).to_pylist()], dtype=int)
    weight = rows.column(1).to_numpy() / rates[cast]  # how many documents each row stands for

    def scorer(column: int, posterior: np.ndarray) -> Scorer:
        features = [np.asarray(x.values.to_numpy()) for x in rows.column(column)]
        return train(features, posterior[cast], weight=weight)

    return Models(scorer(2, posteriors[0]), scorer(3, posteriors[1]), lists)


def scores(text: Column, models: Models) -> Column:
    """Struct (junk, toxic) of the scorers' probabilities for a text; a null text is an empty one."""
    junk, toxic = models.junk, models.toxic
    memory: list[WordSlots] = []

    @F.pandas_udf("junk double, toxic double")
    def score(texts: pd.Series) -> pd.DataFrame:
        if not memory:
            memory.append(WordSlots(toxic.weights != 0))
        made = []
        for text in texts:
            text = text or ""
            words = text.split()
            slots = list(word_slots(text.lower().split(), memory[0]))
            made.append((junk.score(shape_slots(shape(words, text))), toxic.score(slots)))
        return pd.DataFrame(made, columns=["junk", "toxic"], dtype=float)

    # else the optimiser copies the call into every filter and projection that names its result
    return score.asNondeterministic()(text)


def passing(made: Column, models: Models) -> Column:
    return (made["junk"] <= models.junk.threshold) & (made["toxic"] <= models.toxic.threshold)


def classify(
    docs: DataFrame, labels: DataFrame | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row of ``docs``, all its columns, with ``_junk``, ``_toxic`` (probabilities) and ``_keep``.

    A row is kept unless one of its probabilities is over its scorer's threshold. Null and empty texts
    are scored as empty ones; repeated rows alike; an empty table gives an empty result.
    """
    models = fit(docs, labels, id_col, text_col)
    made = F.col("__llm_scores")
    scored = docs.withColumn("__llm_scores", scores(F.col(text_col), models))
    return scored.withColumns(
        {"_junk": made["junk"], "_toxic": made["toxic"], "_keep": passing(made, models)}
    ).drop("__llm_scores")


def kept(docs: DataFrame, labels: DataFrame | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, its own columns, without the rows that the classifier rejects."""
    models = fit(docs, labels, id_col, text_col)
    scored = docs.withColumn("__llm_scores", scores(F.col(text_col), models))
    return scored.where(passing(F.col("__llm_scores"), models)).drop("__llm_scores")
