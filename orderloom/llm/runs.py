"""Periodic runs of words, found through string synchronising sets.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are identical), at
least ``max(LEAST_LENGTH, EXPONENT * q)`` words long, which no neighbouring word extends.

At scale ``t`` (a power of two) a position is synchronising if the smallest hash of a block of ``t`` words
among those that begin at ``i`` to ``i + t`` is the one at either end, so the choice depends on the next
``2t`` words only, and equal stretches have equal choices. Blocks that are themselves highly periodic take
no part, else a repetition would make every position of it synchronising. A run of period ``t <= p < 2t``
of at least ``4p`` words holds two synchronising positions ``p`` apart with the same ``2t`` words behind
them, and no nearer pair: so the next position of the same context proposes the period, and the proposal is
extended word by word. Periods under ``FIRST_SCALE`` are omitted there and read off directly.

The documents of a batch are searched together, as one array of word numbers with a separator of its own
behind each document; those too short for a scale leave before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from orderloom.llm.common import prepare, whole_text
from orderloom.llm.words import Numbering

EXPONENT = 4
LEAST_LENGTH = 6
FIRST_SCALE = 8

#: Words searched together; a longer document is searched alone.
GROUP_WORDS = 1 << 19

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _ahead(values: np.ndarray, by: int) -> np.ndarray:
    """The value ``by`` places on; behind the end, one that equals no other."""
    tail = np.arange(min(by, len(values)), dtype=np.uint64) + np.uint64(len(values))
    return np.concatenate([values[by:], _mixed(tail ^ _NONE)])


def _doubled(blocks: np.ndarray, size: int) -> np.ndarray:
    """Hashes of blocks of ``2 * size`` words from those of ``size`` words."""
    return _mixed(blocks ^ _mixed(_ahead(blocks, size)))


def _next_equal(values: np.ndarray) -> np.ndarray:
    """For each place, how far on the same value stands next; 0 if nowhere."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    far = np.zeros(len(values), dtype=np.int64)
    twin = ranked[1:] == ranked[:-1]
    far[order[:-1][twin]] = order[1:][twin] - order[:-1][twin]
    return far


def _periodic(halves: np.ndarray, scale: int) -> np.ndarray:
    """Whether the ``scale`` words from each place on have a period of at most a quarter of them."""
    half = scale // 2
    far = _next_equal(halves)
    found = np.zeros(len(halves), dtype=bool)
    at = np.flatnonzero((far > 0) & (far <= scale // 4))
    at = at[at + half < len(halves)]
    found[at] = halves[at + half - far[at]] == halves[at + half]
    return found


def _synchronising(blocks: np.ndarray, periodic: np.ndarray, scale: int) -> np.ndarray:
    """Places whose block, or the block ``scale`` words on, has the smallest hash of the blocks from one to the other."""
    offered = np.where(periodic, _NONE, blocks)
    least, width = offered, 1
    while width < scale:  # smallest of ``width`` neighbours, by doubling
        least = np.minimum(least, np.concatenate([least[width:], np.full(min(width, len(least)), _NONE)]))
        width *= 2
    ends = np.concatenate([offered[scale:], np.full(min(scale, len(offered)), _NONE)])
    least = np.minimum(least, ends)
    return np.flatnonzero((least != _NONE) & ((least == offered) | (least == ends)))


def _matching(words: np.ndarray, left: np.ndarray, period: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``left`` on, in the direction of ``step``, equal those ``period`` further right."""
    found = np.zeros(len(left), dtype=np.int64)
    active, width = np.arange(len(left)), 16
    while len(active):
        width = max(16, min(width * 2, (1 << 20) // len(active)))
        at = left[active, None] + step * (found[active, None] + np.arange(width))
        # separators at both ends of the array stop every walk, so a place outside is never the first to differ
        other = np.clip(at + period[active, None], 0, len(words) - 1)
        differ = words[np.clip(at, 0, len(words) - 1)] != words[other]
        some = differ.any(axis=1)
        found[active] += np.where(some, differ.argmax(axis=1), width)
        active = active[~some]
    return found


def _proposed(words: np.ndarray, blocks: tuple[np.ndarray, np.ndarray, np.ndarray], scale: int) -> np.ndarray:
    """Runs (start, end, period) with ``scale <= period < 2 * scale``."""
    halves, whole, contexts = blocks
    chosen = _synchronising(whole, _periodic(halves, scale), scale)
    order = np.lexsort((chosen, contexts[chosen]))
    first, then = chosen[order[:-1]], chosen[order[1:]]
    period = then - first
    pairs = (contexts[first] == contexts[then]) & (period >= scale) & (period < 2 * scale)
    first, period = first[pairs], period[pairs]
    if not len(first):
        return np.zeros((0, 3), dtype=np.int64)
    order = np.lexsort((first, period))
    first, period = first[order], period[order]
    # pairs of one period whose stretches overlap by a period or more lie in one run
    begins = np.flatnonzero(np.r_[True, (np.diff(period) != 0) | (np.diff(first) > 2 * scale)])
    last = first[np.r_[begins[1:] - 1, len(first) - 1]]
    first, period = first[begins], period[begins]
    start = first - _matching(words, first - 1, period, -1)
    end = last + 2 * scale + period
    end = end + _matching(words, last + 2 * scale, period, 1)
    return np.stack([start, end, period], axis=1)


def _short(words: np.ndarray) -> list[np.ndarray]:
    """Runs of periods under ``FIRST_SCALE``: the words equal to those a period on, as stretches."""
    found = []
    for period in range(1, min(FIRST_SCALE, len(words))):
        equal = np.concatenate([[False], words[period:] == words[:-period], [False]])
        edges = np.flatnonzero(equal[1:] != equal[:-1])
        start, end = edges[::2], edges[1::2] + period
        long = end - start >= max(LEAST_LENGTH, EXPONENT * period)
        found.append(np.stack([start[long], end[long], np.full(long.sum(), period)], axis=1))
    return found


def runs_of(documents: list[np.ndarray]) -> list[np.ndarray]:
    """For each document, given as word numbers, its runs (start, length, period) by start, then period."""
    sizes = np.asarray([len(d) for d in documents], dtype=np.int64)
    starts = np.cumsum(sizes + 1) - sizes  # a separator stands before each document, and one at the end
    words = np.full(int(sizes.sum()) + len(sizes) + 1, -1, dtype=np.int64)
    for start, document in zip(starts.tolist(), documents, strict=True):
        words[start : start + len(document)] = document
    marks = np.flatnonzero(words < 0)
    words[marks] = -1 - np.arange(len(marks))

    found = [np.zeros((0, 3), dtype=np.int64), *_short(words)]
    # blocks of 1, 2, 4, ... words of the documents that are long enough for the scale, laid end to end
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    place = np.arange(1, len(words))
    blocks = [_mixed(words[1:].astype(np.uint64))]
    size, scale, texts = 1, FIRST_SCALE, words[1:]
    while len(texts):
        while size < 2 * scale:
            blocks = [*blocks[-2:], _doubled(blocks[-1], size)]
            size *= 2
        some = _proposed(np.concatenate([[np.iinfo(np.int64).min], texts]), tuple(_led(b) for b in blocks), scale)
        # a run lies within one document, so its places move together
        some = some[some[:, 1] - some[:, 0] >= EXPONENT * some[:, 2]]
        shift = place[some[:, 0] - 1] - some[:, 0]
        found.append(some + np.stack([shift, shift, np.zeros_like(shift)], axis=1))
        scale *= 2
        stay = sizes[owner] >= EXPONENT * scale
        owner, place, texts, blocks = owner[stay], place[stay], texts[stay], [b[stay] for b in blocks]

    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    # a stretch also has the multiples of its period: the smallest stands first
    runs = runs[np.r_[True, (np.diff(runs[:, :2], axis=0) != 0).any(axis=1)][: len(runs)]]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    at = np.searchsorted(starts, runs[:, 0], side="right") - 1
    runs = np.stack([runs[:, 0] - starts[at], runs[:, 1] - runs[:, 0], runs[:, 2]], axis=1)
    cuts = np.searchsorted(at, np.arange(len(sizes) + 1))
    return [runs[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _led(blocks: np.ndarray) -> np.ndarray:
    """``blocks`` behind one more value, so that places count from the separator before the first document."""
    return np.concatenate([[_NONE], blocks])


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by one space, each run cut to its first period."""
    if not len(runs):
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(edges[:-1]) == 0
    return b" ".join([words[k] for k in np.flatnonzero(kept)])


def _searched(texts: list[bytes]) -> Iterator[tuple[np.ndarray, bytes]]:
    """Runs and collapsed text of every text, searched in groups."""
    group: list[list[bytes]] = []
    numbers: list[np.ndarray] = []
    known, held = Numbering(), 0

    def done() -> Iterator[tuple[np.ndarray, bytes]]:
        for words, runs in zip(group, runs_of(numbers), strict=True):
            yield runs, collapsed(words, runs)

    for text in texts:
        words = text.split()
        if held and held + len(words) > GROUP_WORDS:
            yield from done()
            group, numbers, known, held = [], [], Numbering(), 0
        group.append(words)
        numbers.append(known.of(words))
        held += len(words)
    yield from done()


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, runs, collapsed) of every row of ``docs``: its runs by start, then period, and its text without them.

    Words are what stands between ASCII white space. ``collapsed`` joins the words by one space and drops those
    that any run holds after its first period. A null or empty text has no runs and an empty ``collapsed``;
    repeated rows and null ids are rows like others; other columns of ``docs`` play no part.
    """
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            made = list(_searched(batch.column(1).cast(pa.binary()).to_pylist()))
            runs = np.concatenate([r for r, _ in made]) if made else np.zeros((0, 3), dtype=np.int64)
            ends = np.cumsum([0, *(len(r) for r, _ in made)]).astype(np.int32)
            rows = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in range(3)], fields=list(out.value_type))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.ListArray.from_arrays(pa.array(ends), rows).cast(out),
                    pa.array([c for _, c in made], type=pa.binary()).cast(pa.string()),
                ],
                names=["_id", "runs", "collapsed"],
            )

    whole = docs.select(docs[id_col].alias("_id"), whole_text(text_col).alias("_whole"))
    return whole.mapInArrow(run, f"_id {kind}, runs array<{RUN}>, collapsed string").withColumnRenamed("_id", id_col)
