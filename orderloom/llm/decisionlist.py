"""Quality rules as a learned decision list over plain statistics of a text.

Sequential covering: a rule is a conjunction of thresholds on statistics. It is grown on two thirds of the
labelled rows by the gain in information until it holds no good row, then pruned on the other third to the
leading conditions with the best balance of bad and good rows. A rule is kept if its precision there, and on
all rows, is high enough; the rows that it covers leave, and the next rule is learned from the rest. The list
reads as an ordered Spark conditional expression: the first rule that holds rejects, none keeps.

Only the rules are fitted on a bounded sample of labelled rows; every statistic covers a whole text, and the
expression is evaluated on every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import prepare, staged_once
from orderloom.llm.words import Numbering, ranked_windows

#: Bounds: labelled documents that rules are learned from, rules of a list, conditions of a rule.
LABELLED_ROWS = 20_000
RULES = 16
CONDITIONS = 4
#: A rule may reject at most one good row in twenty of those that it rejects, and must explain this many rows.
PRECISION = 0.95
LEAST_SUPPORT = 5

LEAST_WORDS = 50
REPEATED_PER_CENT = 50
WINDOW = 3

_SYMBOLS = b"#*$%&|<>"
_NOT_COUNTED = b" \t\n\x0b\x0c\r" + bytes(range(0x80, 0xC0))  # white space, and bytes that continue a code point

#: Whole-text counts, then what the rules judge beside them. A "letter case" is that of A to Z.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHARES = ("chars_per_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "capital_share", "mark_share")
STATISTICS = (*COUNTS, *SHARES)
FEATURES = ("n_words", *SHARES)


def statistics(text: bytes) -> tuple[int | float, ...]:
    """``STATISTICS`` of one whole text; shares of nothing are 0."""
    words = text.split()
    n = len(words)
    chars = len(text.translate(None, _NOT_COUNTED))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated_lines = len(lines) - len(set(lines))
    known = Numbering()
    numbers = known.of(words)
    repeated = _repeated_words(numbers)
    capitals = sum(map(bytes.isupper, words))
    marks = sum(not w.isalnum() and len(w) == 1 for w in words)
    per = 1 / max(1, n)
    counts = (n, chars, symbols, repeated_lines, repeated)
    shares = (chars * per, symbols / max(1, chars), repeated_lines / max(1, len(lines)), repeated * per)
    return (*counts, *shares, len(known) * per, capitals * per, marks * per)


def _repeated_words(numbers: np.ndarray) -> int:
    """How many words stand in a window of ``WINDOW`` words that occurs twice or more."""
    windows = ranked_windows(numbers, WINDOW)
    if not len(windows):
        return 0
    twice = np.flatnonzero(np.bincount(windows)[windows] > 1)
    covered = np.zeros(len(numbers), dtype=bool)
    for k in range(WINDOW):
        covered[twice + k] = True
    return int(covered.sum())


# ---- the list -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        values = x[:, FEATURES.index(self.feature)]
        return values > self.threshold if self.above else values <= self.threshold

    def column(self, statistics: Column) -> Column:
        value = statistics[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        return np.all([c.holds(x) for c in self.conditions], axis=0) if self.conditions else np.ones(len(x), dtype=bool)

    def column(self, statistics: Column) -> Column:
        held = F.lit(True)
        for condition in self.conditions:
            held &= condition.column(statistics)
        return held

    def __str__(self) -> str:
        return " AND ".join(map(str, self.conditions))


@dataclass(frozen=True)
class DecisionList:
    rules: tuple[Rule, ...]

    def rejects(self, x: np.ndarray) -> np.ndarray:
        found = np.zeros(len(x), dtype=bool)
        for rule in self.rules:
            found |= rule.holds(x)
        return found

    def fired(self, statistics: Column) -> Column:
        """The number, from 1, of the first rule that holds; null if none does."""
        if not self.rules:
            return F.lit(None).cast("int")
        cases = F.when(self.rules[0].column(statistics), 1)
        for k, rule in enumerate(self.rules[1:], 2):
            cases = cases.when(rule.column(statistics), k)
        return cases

    def __str__(self) -> str:
        return "\n".join(f"IF {rule} THEN reject" for rule in self.rules) + "\nELSE keep"


def _best_cut(values: np.ndarray, bad: np.ndarray) -> tuple[float, float, bool, float]:
    """(gain, gap, above, threshold) of the best threshold half-way between neighbouring values; the widest gap of equal ones."""
    order = np.argsort(values, kind="stable")
    values, below = values[order], np.cumsum(bad[order])
    at = np.flatnonzero(values[1:] > values[:-1])  # the last place of each value but the largest
    if not len(at):
        return 0.0, 0.0, True, 0.0
    bads = np.concatenate([below[at], below[-1] - below[at]])
    rows = np.concatenate([at + 1, len(values) - at - 1])
    with np.errstate(divide="ignore"):
        gain = np.where(bads >= LEAST_SUPPORT, bads * (np.log2(np.maximum(bads, 1) / rows) - np.log2(bad.mean())), 0.0)
    gap = np.tile(values[at + 1] - values[at], 2)
    k = np.lexsort((gap, gain.round(9)))[-1]
    cut = at[k % len(at)]
    return float(gain[k]), float(gap[k]), bool(k >= len(at)), float((values[cut] + values[cut + 1]) / 2)


def _grown(x: np.ndarray, bad: np.ndarray) -> Rule:
    """Conditions added by the largest gain in information about ``bad`` until no good row is covered."""
    conditions: list[Condition] = []
    held = np.ones(len(x), dtype=bool)
    while len(conditions) < CONDITIONS and (~bad[held]).any():
        cuts = [_best_cut(x[held, k], bad[held]) for k in range(len(FEATURES))]
        k = max(range(len(cuts)), key=lambda k: cuts[k][0])
        gain, _, above, threshold = cuts[k]
        if gain <= 1e-9:
            break
        conditions.append(Condition(FEATURES[k], above, threshold))
        held &= conditions[-1].holds(x)
    return Rule(tuple(conditions))


def _pruned(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    """The leading conditions of ``rule`` with the best balance of bad against good rows, the fewest of equal ones."""

    def worth(size: int) -> tuple[float, int]:
        held = Rule(rule.conditions[:size]).holds(x)
        p, n = int(bad[held].sum()), int((~bad[held]).sum())
        return (p - n) / max(1, p + n), -size

    sizes = range(1, len(rule.conditions) + 1)
    return Rule(rule.conditions[: max(sizes, key=worth)]) if rule.conditions else rule


def _precise(rule: Rule, x: np.ndarray, bad: np.ndarray) -> bool:
    held = rule.holds(x)
    return bad[held].sum() >= LEAST_SUPPORT and bad[held].mean() >= PRECISION


def learn(x: np.ndarray, bad: np.ndarray, to_prune: np.ndarray) -> DecisionList:
    """Rules for ``bad`` rows of ``x`` (a column a feature); ``to_prune`` tells the rows kept from growing."""
    rules: list[Rule] = []
    left = np.ones(len(x), dtype=bool)
    while len(rules) < RULES and (left & bad & ~to_prune).sum() >= LEAST_SUPPORT:
        grow, prune = left & ~to_prune, left & to_prune
        rule = _grown(x[grow], bad[grow])
        if prune.any():
            rule = _pruned(rule, x[prune], bad[prune])
        # against all rows: what earlier rules cover shows nothing about a rule that would hold there too
        if not rule.conditions or not _precise(rule, x[left], bad[left]):
            break
        rules.append(rule)
        left &= ~rule.holds(x)
    return DecisionList(tuple(rules))


# ---- on Spark -------------------------------------------------------------------------------------

_FIELDS = T.StructType(
    [*(T.StructField(c, T.LongType()) for c in COUNTS), *(T.StructField(c, T.DoubleType()) for c in SHARES)]
)


def with_statistics(docs: DataFrame, text_col: str, into: str) -> DataFrame:
    """``docs`` with a struct column ``into`` of the statistics of each whole text, a null one empty."""
    at = docs.columns.index(text_col)
    out = pa.struct([*((c, pa.int64()) for c in COUNTS), *((c, pa.float64()) for c in SHARES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [statistics(t or b"") for t in batch.column(at).cast(pa.binary()).to_pylist()]
            columns = zip(*made, strict=True) if made else [[] for _ in STATISTICS]
            fields = [pa.array(c, type=f.type) for c, f in zip(columns, out, strict=True)]
            made = pa.StructArray.from_arrays(fields, fields=list(out))
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, into])

    return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField(into, _FIELDS)]))


def fit(
    docs: DataFrame,
    labels: DataFrame | None,
    id_col: str = "doc_id",
    text_col: str = "text",
    labelled_rows: int = LABELLED_ROWS,
) -> DecisionList:
    """Learn the list from ``labels`` (id, quality 0/1): at most ``labelled_rows`` of them, drawn by a hash of the id.

    Labels of a null id, of null quality or of an unknown document have no effect; of repeated labels the worse
    counts; of documents with one id, one stands for all. Without bad and good labels the list is empty.
    """
    if labels is None:
        return DecisionList(())
    prepare(docs.sparkSession)
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col("quality").isin(0, 1))
        .groupBy(F.col(id_col).alias("_of"))
        .agg(F.min(F.col("quality").cast("int")).alias("_quality"))
    )
    draw = F.xxhash64("_of", F.lit(17))
    drawn = staged_once(known.orderBy(draw, "_of").limit(labelled_rows), "labelled")  # bounded, so it may go to every task
    whole = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_whole"))
    texts = whole.join(F.broadcast(drawn), F.col("_id") == F.col("_of")).select("_of", "_quality", "_whole")
    held = F.pmod(F.xxhash64("_of", F.lit(29)), F.lit(3)) == 0
    rows = (
        with_statistics(texts, "_whole", "_s")
        .groupBy("_of")
        .agg(F.min(F.struct("_quality", "_s")).alias("_row"))
        .select("_row._quality", held.alias("_held"), *(F.col(f"_row._s.{c}").cast("double").alias(c) for c in FEATURES))
        .toPandas()
    )
    rows = rows.sort_values(list(rows.columns))
    x = rows[list(FEATURES)].to_numpy(dtype=float).reshape(-1, len(FEATURES))
    bad, to_prune = rows["_quality"].to_numpy() == 0, rows["_held"].to_numpy().astype(bool)
    return learn(x, bad, to_prune) if bad.any() and (~bad).any() else DecisionList(())


def base_failed(statistics: Column) -> Column:
    n, repeated = statistics["n_words"], statistics["n_repeat_words"]
    return (n < LEAST_WORDS) | (100 * repeated > REPEATED_PER_CENT * n)


def judge(docs: DataFrame, rules: DecisionList, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, the five counts, base_failed, kept, rule) of every row of ``docs``.

    ``rule`` is the number of the learned rule that rejects, from 1, or null. A row that fails the base rules is
    not kept, whatever the list says. Null and empty texts have no words, so they fail; repeated rows are judged
    alike; an empty table gives an empty result; other columns of ``docs`` play no part.
    """
    prepare(docs.sparkSession)
    s = F.col("_s")
    made = with_statistics(docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_whole")), "_whole", "_s")
    made = made.select("_id", "_s", base_failed(s).alias("_failed"), rules.fired(s).alias("_rule"))
    return made.select(
        F.col("_id").alias(id_col),
        *(s[c].alias(c) for c in COUNTS),
        F.col("_failed").alias("base_failed"),
        (~F.col("_failed") & F.col("_rule").isNull()).alias("kept"),
        F.col("_rule").alias("rule"),
    )


def kept(docs: DataFrame, rules: DecisionList, text_col: str = "text") -> DataFrame:
    """``docs``, its own columns, without the rows that the base rules or the list reject."""
    prepare(docs.sparkSession)
    made = with_statistics(docs, text_col, "__llm_statistics")
    s = F.col("__llm_statistics")
    return made.where(~base_failed(s) & rules.fired(s).isNull()).drop("__llm_statistics")
