"""Phrase collocations from bidirectional FM-indexes over word numbers.

Tasks cut the corpus into shards of one language. A shard numbers its words, lays its pieces end to end
with separators between them, and builds the Burrows-Wheeler transforms of this sequence and of its
reverse. A phrase is a pair of intervals, one in each: a step through the reverse transform extends it by a
word to the right and narrows both, the forward transform tells what stands to its left. Phrases are
enumerated level by level, all intervals of a level at once. No phrase is longer than ``LONGEST`` words, so
suffixes are sorted by that many words only.

Counts are summed across shards in two passes. The first counts pairs of words, under 64-bit keys. The second
lists words and phrases, the latter only as long as all their pairs are frequent in the whole corpus, since no
phrase is more frequent than they are. Tasks know those pairs from a Bloom filter of fixed size. Neither keys that
collide nor the filter ever miss a frequent pair, and what they let through wrongly falls to the exact sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm import bitfilter
from orderloom.llm.common import prepare, staged_once
from orderloom.llm.words import Numbering

LONGEST = 3
LEAST_COUNT = 10
TOP = 2000
SUBSUMED = 50  # per cent
NO_LANGUAGE = "und"

#: Words of a shard; a longer document is a shard of its own.
SHARD_WORDS = 1 << 21
SLICE_ROWS = 50_000

#: The marks between pieces, as the last of which all of them are written.
_BREAKS = b"\n\x0b\x0c\r.,;:!?"
_MARK = b"."
_AS_MARK = bytes.maketrans(_BREAKS, _MARK * len(_BREAKS))


def tokens(text: bytes) -> list[bytes]:
    """Lower-case words of a text and ``_MARK`` for every break between pieces."""
    return text.lower().translate(_AS_MARK).replace(_MARK, b" . ").split()


# ---- the index of one shard -----------------------------------------------------------------------


@dataclass(frozen=True)
class Transform:
    """A Burrows-Wheeler transform of numbers between separators 0, for phrases of a bounded length."""

    before: np.ndarray  # for each sorted suffix, the number ahead of it
    steps: np.ndarray  # for each sorted suffix, the place of the one that begins a number earlier

    @staticmethod
    def of(numbers: np.ndarray, longest: int) -> Transform:
        many = int(numbers.max()) + 1
        shifted = [np.roll(numbers, -k) for k in range(longest)]
        if many**longest < 1 << 63:
            key = shifted[0]
            for x in shifted[1:]:
                key = key * many + x
            order = np.argsort(key, kind="stable")
        else:
            order = np.lexsort(shifted[::-1])
        before = numbers[order - 1]
        steps = np.empty_like(before)
        steps[np.argsort(before, kind="stable")] = np.arange(len(before))
        return Transform(before, steps)


@dataclass(frozen=True)
class Phrases:
    """Phrases of one length: their numbers and their intervals in both transforms."""

    numbers: np.ndarray  # a row for each phrase
    forward: np.ndarray  # where the interval begins in the transform of the text
    backward: np.ndarray  # and in that of the reversed text
    count: np.ndarray

    def where(self, some: np.ndarray) -> Phrases:
        return Phrases(self.numbers[some], self.forward[some], self.backward[some], self.count[some])


def single_words(numbers: np.ndarray) -> Phrases:
    count = np.bincount(numbers)
    start = np.cumsum(count) - count
    words = np.arange(1, len(count))
    return Phrases(words[:, None], start[1:], start[1:], count[1:])


def extended(phrases: Phrases, reverse: Transform) -> Phrases:
    """All phrases that are one of ``phrases`` and one word more on the right."""
    ends = np.cumsum(phrases.count)
    begins = ends - phrases.count
    parent = np.repeat(np.arange(len(ends)), phrases.count)
    rows = np.arange(len(parent)) + (phrases.backward - begins)[parent]
    word = reverse.before[rows]
    key = parent * (int(word.max(initial=0)) + 1) + word
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
    count = np.diff(np.r_[first, len(key)])
    at = order[first]
    some = word[at] > 0  # 0: a piece ends here
    first, count, at = first[some], count[some], at[some]
    up = parent[at]
    return Phrases(
        np.concatenate([phrases.numbers[up], word[at][:, None]], axis=1),
        phrases.forward[up] + first - begins[up],
        reverse.steps[rows[at]],
        count,
    )


def neighboured(transform: Transform, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """How many of the occurrences in each interval have a word, not a separator, ahead of them."""
    words = np.r_[0, np.cumsum(transform.before > 0)]
    return words[start + count] - words[start]


# ---- keys of pairs --------------------------------------------------------------------------------


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), dtype=np.uint64, count=len(words))


def _pair_keys(language: str, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit keys of pairs of words, given as hashes."""
    mixed = (left * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(xxhash.xxh64_intdigest(language.encode()))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + right
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return mixed ^ (mixed >> np.uint64(31))


# ---- shards and their sums ------------------------------------------------------------------------


class _Shard:
    """Words of one language as they come."""

    def __init__(self) -> None:
        self.known = Numbering((_MARK,))
        self.parts = [np.zeros(1, dtype=np.int64)]

    def add(self, words: list[bytes]) -> None:
        self.parts += [self.known.of(words), self.parts[0]]

    def numbers(self) -> np.ndarray:
        return np.concatenate(self.parts)


def _in_slices(names: list[str], arrays: list[pa.Array]) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(arrays[0]), SLICE_ROWS):
        yield pa.RecordBatch.from_arrays([a.slice(start, SLICE_ROWS) for a in arrays], names=names)


def _listed(language: str, phrases: Phrases, words: pa.Array, left: np.ndarray, right: np.ndarray) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(phrases.count), SLICE_ROWS):
        here = slice(start, start + SLICE_ROWS)
        parts = [words.take(pa.array(x)) for x in phrases.numbers[here].T]
        if not parts:
            text = pa.array([b""], pa.binary())
        else:
            text = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()))
        counts = [pa.array(c[here]) for c in (phrases.count, left, right)]
        arrays = [pa.array([language] * len(text), pa.string()), text.cast(pa.string()), *counts]
        yield pa.RecordBatch.from_arrays(arrays, names=["lang", "phrase", "a", "left", "right"])


def _pair_counts(language: str, shard: _Shard) -> Iterator[pa.RecordBatch]:
    """Counts of pairs of words, under their keys."""
    numbers = shard.numbers()
    hashes = _word_hashes(list(shard.known))
    pairs = extended(single_words(numbers), Transform.of(numbers[::-1], 2))
    keys = _pair_keys(language, *(hashes[x] for x in pairs.numbers.T))
    yield from _in_slices(["key", "a"], [pa.array(keys.view(np.int64)), pa.array(pairs.count)])


def _phrase_counts(language: str, shard: _Shard, pairs: np.ndarray, longest: int) -> Iterator[pa.RecordBatch]:
    """Counts of words, and of phrases all of whose pairs are frequent, as far as the filter tells.

    The empty phrase stands for every word and counts them all.
    """
    numbers = shard.numbers()
    words = pa.array(list(shard.known), pa.binary())
    hashes = _word_hashes(list(shard.known))
    forward, reverse = Transform.of(numbers, longest), Transform.of(numbers[::-1], longest)
    phrases, total = single_words(numbers), np.asarray([(numbers > 0).sum()])
    yield from _listed(language, Phrases(np.zeros((1, 0), np.int64), total, total, total), words, total, total)
    for size in range(1, longest + 1):
        if size > 1:
            phrases = extended(phrases, reverse)
            last = phrases.numbers[:, -2:]
            phrases = phrases.where(bitfilter.passes(pairs, _pair_keys(language, hashes[last[:, 0]], hashes[last[:, 1]])))
        left = neighboured(forward, phrases.forward, phrases.count)
        right = neighboured(reverse, phrases.backward, phrases.count)
        yield from _listed(language, phrases, words, left, right)


def _sharded(texts: DataFrame, schema: str, made) -> DataFrame:
    """``made(language, shard)`` of every shard of rows (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[str, _Shard] = {}
        held = 0
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True)
            for language, text in rows:
                words = tokens(text.as_py())
                shards.setdefault(language, _Shard()).add(words)
                held += len(words)
                if held >= SHARD_WORDS:
                    for name, shard in shards.items():
                        yield from made(name, shard)
                    shards, held = {}, 0
        for name, shard in shards.items():
            yield from made(name, shard)

    return texts.mapInArrow(run, schema)


def phrase_counts(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST_COUNT, lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """(lang, phrase, a, left, right) of every phrase of at most ``longest`` words that occurs ``least`` times.

    ``left`` and ``right`` tell how many of the ``a`` occurrences have a word of the same piece before and behind
    them. The empty phrase is there for every language and counts all its words.
    """
    prepare(docs.sparkSession)
    texts = docs.select(
        F.coalesce(docs[lang_col].cast("string"), F.lit(NO_LANGUAGE)).alias("_lang"),
        F.coalesce(docs[text_col], F.lit("")).alias("_text"),
    )
    pairs = _sharded(texts, "key long, a long", _pair_counts).groupBy("key").agg(F.sum("a").alias("a"))
    known = bitfilter.build(pairs.where(F.col("a") >= least))
    counts = _sharded(
        texts,
        "lang string, phrase string, a long, left long, right long",
        lambda language, shard: _phrase_counts(language, shard, known, longest),
    )
    counts = counts.groupBy("lang", "phrase").agg(*(F.sum(c).alias(c) for c in ("a", "left", "right")))
    return staged_once(counts.where((F.col("a") >= least) | (F.col("phrase") == "")), "phrases")


# ---- collocations ---------------------------------------------------------------------------------


def _joined(words: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def _scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """Candidates with ``l``, ``r`` and ``score`` of their lowest-scoring cut, of equal ones the first."""
    words = F.split("phrase", " ")
    cuts = candidates.withColumn("_k", F.explode(F.sequence(F.lit(1), F.size(words) - 1))).withColumns(
        {
            "_first": _joined(words, F.lit(1), F.col("_k")),
            "_rest": _joined(words, F.col("_k") + 1, F.size(words) - F.col("_k")),
        }
    )
    # a part occurs at least as often as the whole, so every part is among the counts
    for part, name in (("_first", "l"), ("_rest", "r")):
        sides = counts.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("a").alias(name))
        cuts = cuts.join(sides, (F.col("lang") == F.col("_lang")) & (F.col(part) == F.col("_part"))).drop("_lang", "_part")
    score = F.expr("(CAST(1000000 AS DECIMAL(38, 0)) * a * a) DIV (CAST(l AS DECIMAL(38, 0)) * r)")
    best = F.min(F.struct(score.alias("score"), "_k", "l", "r")).alias("_best")
    cut = cuts.groupBy("lang", "phrase").agg(best, *(F.first(c).alias(c) for c in ("a", "left", "right")))
    return cut.select("lang", "phrase", "a", "left", "right", "_best.l", "_best.r", "_best.score")


def _standing(candidates: DataFrame, subsumed: int) -> DataFrame:
    """Candidates without those that stand inside a longer one at least ``subsumed`` per cent as frequent."""
    words = F.split("phrase", " ")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.size(words) - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.size(words) - size + 1), lambda start: _joined(words, start, size)
            ),
        )
    )
    within = candidates.where(F.size(words) > 2).select(
        F.col("lang").alias("_lang"), F.explode(inner).alias("_inner"), F.col("a").alias("_longer")
    )
    within = within.groupBy("_lang", "_inner").agg(F.max("_longer").alias("_longer"))
    inside = (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_inner"))
    swallowed = F.lit(100) * F.col("_longer") >= F.lit(subsumed) * F.col("a")
    return candidates.join(within.alias("w"), inside & swallowed, "left_anti")


def _first_of_each(rows: DataFrame, top: int) -> DataFrame:
    """The best ``top`` phrases of each language with their ``rank``, first within parts of a language."""
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    rows = rows.withColumn("_part", part)
    rows = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*best)))
    rows = rows.where(F.col("_rank") <= top).drop("_part", "_rank")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")
    return rows.withColumn("rank", rank).where(F.col("rank") <= top)


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST_COUNT,
    top: int = TOP,
    subsumed: int = SUBSUMED,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """The ``top`` phrases of each language: (lang, rank, phrase, a, l, r, n, score, left, right).

    A phrase of two to ``longest`` words that occurs ``a >= least`` times within pieces scores
    ``floor(1000000 * a * a / (l * r))`` for its worst cut into parts that occur ``l`` and ``r`` times; ``n`` is
    the number of words of the language. Phrases inside a longer one that is nearly as frequent are left out.
    ``left`` and ``right`` count occurrences with a neighbouring word on that side. Null texts are empty, a null
    language is ``und``; repeated rows count again, ids and other columns play no part; a language without a
    frequent phrase has no row.
    """
    counts = phrase_counts(docs, longest, least, lang_col, text_col)
    totals = counts.where("phrase = ''").selectExpr("lang", "a AS n")
    candidates = counts.where(F.col("phrase").contains(" "))
    scored = _scored(_standing(candidates, subsumed), counts)
    found = _first_of_each(scored, top).join(totals, "lang")
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "left", "right")
