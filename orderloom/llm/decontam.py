"""Benchmark decontamination with spaced seeds.

A seed is a fixed mask over a window of words: positions it ignores may differ. The masked hashes of the
test items are joined with those of the training texts, one row for each hash and text, however often a text
repeats it. Before the join the training side keeps the windows whose hash passes a filter of fixed size built
from all test hashes. Texts and items that meet are verified on every alignment on which a seed agrees: some window
of it must agree in four fifths of its words. Equal texts are compared once; their rows are told by content keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm import bitfilter
from orderloom.llm.common import prepare, staged_once, whole_text

#: Masks by the width of the window that must agree, chosen by enumeration: whatever words of such a window
#: differ, as long as ``SHARE`` of them agree, some mask fits on agreeing words at some place of it.
MASKS = {
    5: ("1111", "10111", "11101", "11011"),
    6: ("11101", "10111"),
    7: ("111101", "101111", "110111"),
    8: ("1111011", "111111", "1101111"),
    9: ("1101111", "11111001"),
    10: ("110111", "11001011", "101010011"),
    11: ("1101111", "111100011", "1100011011"),
    12: ("11010111", "11101000011", "1100011011"),
    13: ("111101011", "11001001111", "110001110011"),
}
#: A leak agrees in this share of the words of a window this long (or of the whole item, if shorter); items
#: of fewer words than the least are too short to tell a leak by.
WINDOW_WORDS = 13
LEAST_WORDS = 5
SHARE = 0.8

REMEMBERED_WORDS = 150_000
_CELLS = 1 << 20  # of arrays compared at once
_STREAM = 1 << 17  # words of texts hashed at once


class WordHashes(dict):
    """64-bit hash of a word without the marks around it, lower-cased; 0 for a word of marks only."""

    def __missing__(self, word: str) -> int:
        from xxhash import xxh64_intdigest

        low, high = 0, len(word)
        while low < high and not word[low].isalnum():
            low += 1
        while high > low and not word[high - 1].isalnum():
            high -= 1
        made = xxh64_intdigest(word[low:high]) | 1 if high > low else 0
        if len(word) <= 64:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            self[word] = made
        return made


def word_hashes(words: WordHashes, text: str | None) -> np.ndarray:
    split = (text or "").lower().split()
    found = np.fromiter(map(words.__getitem__, split), np.uint64, len(split))
    return found[found != 0]


def _seed_hash(stream: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the mask and of the words under it, for every window of the stream."""
    n = len(stream) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total, factor = np.full(n, crc32(mask.encode()), np.uint64), np.uint64(0x9E3779B97F4A7C15)
    for at, bit in enumerate(mask):
        if bit == "1":
            total += stream[at : at + n]
            total *= factor
    return total ^ (total >> np.uint64(29))


def masks_of(item: np.ndarray) -> tuple[str, ...]:
    return MASKS[min(WINDOW_WORDS, len(item))] if len(item) >= LEAST_WORDS else ()


def _diagonals(text: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Starts of the item in the text, negative ones too, at which some seed of both agrees, in order."""
    met = np.zeros(len(text) + len(item) + 1, dtype=bool)
    for mask in masks_of(item):
        mine, theirs = _seed_hash(text, mask), _seed_hash(item, mask)
        order = np.argsort(mine, kind="stable")
        low = np.searchsorted(mine[order], theirs, side="left")
        high = np.searchsorted(mine[order], theirs, side="right")
        for place in np.flatnonzero(high > low).tolist():  # marked one by one: no product of repeated words is built
            met[order[low[place] : high[place]] - place + len(item)] = True
    return np.flatnonzero(met) - len(item)


def overlap(text: np.ndarray, item: np.ndarray) -> tuple[int, int, int] | None:
    """(first word, words, agreeing words) of the longest leak of the item into the text, over all alignments."""
    width, best = min(WINDOW_WORDS, len(item)), None
    starts = _diagonals(text, item)
    rows = max(1, _CELLS // max(1, len(item)))
    for at in range(0, len(starts), rows):
        start = starts[at : at + rows, None]
        place = start + np.arange(len(item))
        inside = (place >= 0) & (place < len(text))
        agree = inside & (text[np.clip(place, 0, len(text) - 1)] == item)
        sums = np.concatenate([np.zeros((len(start), 1), np.int64), np.cumsum(agree, axis=1)], axis=1)
        good = (sums[:, width:] - sums[:, :-width] >= SHARE * width) & inside[:, : len(item) - width + 1] & inside[:, width - 1 :]
        some = np.flatnonzero(good.any(axis=1))
        first = good[some].argmax(axis=1)
        last = len(item) - good[some, ::-1].argmax(axis=1)
        agreeing = sums[some, last] - sums[some, first]
        for k in np.lexsort((some, -agreeing, first - last))[:1]:
            found = (int(start[some[k], 0] + first[k]), int(last[k] - first[k]), int(agreeing[k]))
            if best is None or found[1:] > best[1:]:
                best = found
    return best


# ---- on Spark -------------------------------------------------------------------------------------

_KEY = ("_k1", "_k2")


def _keys(text: Column) -> list[Column]:
    """128 bits that tell a text."""
    return [F.xxhash64(F.lit(k), text).alias(name) for k, name in enumerate(_KEY)]


def _item_seeds(items: DataFrame) -> DataFrame:
    """(key, width, _i1, _i2): the seeds of rows (_k1, _k2, _text), each hash of an item once.

    ``width`` is that of the window whose masks made them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            for row, text in enumerate(batch.column(2).to_pylist()):
                item = word_hashes(words, text)
                parts = [np.zeros(0, np.uint64), *(_seed_hash(item, mask) for mask in masks_of(item))]
                hashes = np.unique(np.concatenate(parts)).view(np.int64)
                owner = pa.array(np.full(len(hashes), row))
                width = pa.array(np.full(len(hashes), min(WINDOW_WORDS, len(item)), np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes), width, *(batch.column(k).take(owner) for k in (0, 1))],
                    names=["key", "width", "_i1", "_i2"],
                )

    return items.select(*_KEY, "_text").mapInArrow(run, "key long, width int, _i1 long, _i2 long")


def _text_seeds(texts: DataFrame, bits: np.ndarray, masks: tuple[str, ...]) -> DataFrame:
    """(key, _k1, _k2): the seeds of rows (_k1, _k2, _text) that pass the filter, each hash of a text once."""

    def found(arrays: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash), each once, of texts that are hashed as one stream."""
        starts = np.cumsum([0, *(len(x) for x in arrays)])
        stream = np.concatenate(arrays)
        owners, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for mask in masks:
            made = _seed_hash(stream, mask)
            spots = bitfilter.passing(bits, made)
            rows = np.searchsorted(starts, spots, side="right") - 1
            within = spots + len(mask) <= starts[rows + 1]  # not over the end of its text
            owners.append(rows[within])
            hashes.append(made[spots[within]])
        owner, key = np.concatenate(owners), np.concatenate(hashes)
        order = np.lexsort((key, owner))
        owner, key = owner[order], key[order]
        fresh = np.r_[True, (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])][: len(owner)]
        return owner[fresh], key[fresh]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            held, size, first = [], 0, 0
            for row in range(batch.num_rows):
                held.append(word_hashes(words, batch.column(2)[row].as_py()))
                size += len(held[-1])
                if size < _STREAM and row + 1 < batch.num_rows:
                    continue
                owner, key = found(held)
                at = pa.array(owner + first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), *(batch.column(k).take(at) for k in (0, 1))], names=["key", *_KEY]
                )
                held, size, first = [], 0, row + 1

    return texts.select(*_KEY, "_text").mapInArrow(run, "key long, _k1 long, _k2 long")


def _verified(pairs: DataFrame) -> DataFrame:
    """The leaks among rows (_k1, _k2, _text, _i1, _i2, _item): keys, first_word, words, agreeing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        now, text = None, np.zeros(0, np.uint64)
        for batch in batches:
            rows, found = [], []
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for row, key in enumerate(keys):
                if key != now:  # the items of a text stand together
                    now, text = key, word_hashes(words, batch.column(2)[row].as_py())
                if seen := overlap(text, word_hashes(words, batch.column(5)[row].as_py())):
                    rows.append(row)
                    found.append(seen)
            at = pa.array(rows, type=pa.int64())
            figures = [pa.array([f[k] for f in found], type=pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(at) for k in (0, 1, 3, 4)), *figures],
                names=[*_KEY, "_i1", "_i2", "first_word", "words", "agreeing"],
            )

    pairs = pairs.select(*_KEY, "_text", "_i1", "_i2", "_item")
    return pairs.mapInArrow(
        run, "_k1 long, _k2 long, _i1 long, _i2 long, first_word long, words long, agreeing long"
    )


def _leaks(texts: DataFrame, items: DataFrame) -> DataFrame:
    """Leaks between rows (_k1, _k2, _text) and distinct rows (_i1, _i2, _item), by their keys."""
    seeds = staged_once(_item_seeds(items.withColumnsRenamed({"_i1": "_k1", "_i2": "_k2", "_item": "_text"})), "test-seeds")
    widths = [r["width"] for r in seeds.select("width").distinct().collect()]  # at most one for each of ``MASKS``
    masks = tuple(sorted({mask for width in widths for mask in MASKS[width]}))
    # a frequent hash is one row a text; adaptive execution splits it among tasks
    hits = _text_seeds(texts, bitfilter.build(seeds.select("key").distinct()), masks)
    met = staged_once(hits.join(seeds, "key").select(*_KEY, "_i1", "_i2").distinct(), "texts-and-tests")
    asked = texts.join(met.select(*_KEY).distinct(), list(_KEY), "left_semi").dropDuplicates(list(_KEY))
    pairs = asked.join(met.join(items, ["_i1", "_i2"]), list(_KEY))
    return _verified(pairs)


def _items(tests: DataFrame, test_text: str) -> DataFrame:
    """Distinct non-empty texts of test items, as (_i1, _i2, _item)."""
    text = F.col(test_text)
    first, second = _keys(text)
    held = tests.where(F.length(text) > 0).select(first.alias("_i1"), second.alias("_i2"), text.alias("_item"))
    return held.dropDuplicates(["_i1", "_i2"])


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    text = whole_text(text_col)
    return docs.select(*_keys(text), text.alias("_text"))


def find_leaks(
    docs: DataFrame,
    tests: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    test_id: str = "item_id",
    test_text: str = "text",
) -> DataFrame:
    """(doc id, item id, first_word, words, agreeing): the longest overlap of each leaking pair of rows.

    Words are compared lower-cased and without the marks around them. Items of fewer than ``LEAST_WORDS`` words are
    too short to tell a leak by and leak nothing, as do null and empty texts on either side. Repeated rows on either
    side each give rows; null ids are carried; other columns are not read; an empty table on either side gives an
    empty result.
    """
    prepare(docs.sparkSession)
    leaks = staged_once(_leaks(_texts(docs, text_col), _items(tests, test_text)), "leaks")
    rows = docs.select(docs[id_col].alias("_doc"), *_keys(whole_text(text_col))).join(leaks, list(_KEY))
    first, second = _keys(F.col(test_text))
    named = tests.where(F.length(test_text) > 0).select(tests[test_id].alias("_test"), first.alias("_i1"), second.alias("_i2"))
    return rows.join(named, ["_i1", "_i2"]).select(
        F.col("_doc").alias(id_col), F.col("_test").alias(test_id), "first_word", "words", "agreeing"
    )


def decontaminated(docs: DataFrame, tests: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs``, its own columns, without the rows that hold a passage of a test item; a row with a null text stays."""
    prepare(docs.sparkSession)
    leaks = _leaks(_texts(docs, text_col), _items(tests, "text"))
    leaking = staged_once(leaks.select(*_KEY).distinct(), "leaking").select(*(F.col(k).alias(f"__llm{k}") for k in _KEY))
    first, second = _keys(whole_text(text_col))
    return docs.join(leaking, (first == F.col("__llm_k1")) & (second == F.col("__llm_k2")), "left_anti")
