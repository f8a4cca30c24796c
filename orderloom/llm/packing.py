"""Best-fit packing of token sequences, after the Martello-Toth dominance reduction.

Only the number of pieces of each length matters to the plan, so the plan is made on that histogram
(one row for each length up to the capacity, however many documents there are) and is itself a short
list of rank ranges. The pieces are then ranked within their length and look their place up.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import TOKENIZER_DIR, prepare, staged_once

CAPACITY = 2048
TOKENIZER = f"{TOKENIZER_DIR}/word_bpe_49k.json"
END_OF_DOCUMENT = 0

#: Words whose ids a Python worker remembers; the memory is emptied when it is full.
REMEMBERED_WORDS = 400_000

#: Pieces in one ranking bucket, about; a hot length is ranked in as many buckets as it takes.
BUCKET_ROWS = 250_000
LEAST_BUCKETS = 64


#: Latin letters with marks behind them: the tokenizer cuts such a word there, into at most two runs.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class RunIds(dict):
    """Ids of a run of lower-case letters or of marks, straight from the tokenizer's model."""

    def __init__(self, model: object) -> None:
        super().__init__({"": b""})
        self.model, self.letters = model, _byte_letters()

    def __missing__(self, run: str) -> bytes:
        tokens = self.model.tokenize(run.encode().decode("latin-1").translate(self.letters))
        ids = np.asarray([t.id for t in tokens], dtype="<u4").tobytes()
        if len(run) <= 64:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
                self[""] = b""
            self[run] = ids
        return ids


class WordIds(dict):
    """Ids of a word as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space and cuts words at it, so a text's ids are its words' ids in order.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__({"": b""})
        self.tokenizer = Tokenizer.from_file(path)
        self.runs = RunIds(self.tokenizer.model)

    def __missing__(self, word: str) -> bytes:
        if plain := _PLAIN.fullmatch(word):
            ids = self.runs[plain[1].lower()] + self.runs[plain[2]]
        else:
            ids = np.asarray(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(word) <= 64:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
                self[""] = b""
            self[word] = ids
        return ids


def text_ids(words: WordIds, text: str) -> bytes:
    return b"".join(map(words.__getitem__, text.replace("\n", " ").split(" ")))


def encode_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str = TOKENIZER,
) -> DataFrame:
    """One row per piece: id, piece (from 0), start, length, ids (binary, little-endian unsigned 32-bit).

    A document is its tokens and the end-of-document id; only one longer than ``capacity`` is cut, into
    pieces of ``capacity`` ids, the last of which may be shorter. A null or empty text gives the single
    end id. Repeated rows give repeated pieces; other columns are not read.
    """
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    out = T.StructType(
        [
            T.StructField(id_col, kind),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    end = np.asarray([END_OF_DOCUMENT], dtype="<u4").tobytes()
    width = 4 * capacity

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(tokenizer)
        for batch in batches:
            owner, piece, ids = [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                data = text_ids(words, text or "") + end
                for at in range(0, len(data), width):
                    owner.append(row)
                    piece.append(at // width)
                    ids.append(data[at : at + width])
            number = np.asarray(piece, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owner, type=pa.int64())),
                    pa.array(number),
                    pa.array(number.astype(np.int64) * capacity),
                    pa.array([len(x) // 4 for x in ids], type=pa.int64()),
                    pa.array(ids, type=pa.binary()),
                ],
                names=out.fieldNames(),
            )

    return docs.select(id_col, text_col).mapInArrow(encode, out)


@dataclass(frozen=True)
class Placed:
    """Pieces ``low`` to ``high`` (ranks within ``length``) go ``each`` to a sequence, from ``first`` on."""

    length: int
    low: int
    high: int
    first: int
    each: int
    offset: int


class _Plan:
    def __init__(self, histogram: dict[int, int]) -> None:
        self.left = Counter({w: n for w, n in histogram.items() if n > 0})
        self.taken: Counter[int] = Counter()
        self.sequences = 0
        self.placed: list[Placed] = []

    def place(self, length: int, many: int, first: int, each: int, offset: int) -> None:
        low = self.taken[length]
        self.placed.append(Placed(length, low, low + many, first, each, offset))
        self.taken[length] += many
        self.left[length] -= many
        if not self.left[length]:
            del self.left[length]

    def fix(self, lengths: list[int], times: int) -> None:
        """``times`` sequences that hold just these lengths."""
        offset = 0
        for length in lengths:
            self.place(length, times, self.sequences, 1, offset)
            offset += length
        self.sequences += times

    def times(self, lengths: list[int]) -> int:
        return min(self.left[w] // n for w, n in Counter(lengths).items())


def dominating_set(left: Counter[int], w: int, capacity: int) -> list[int] | None:
    """A set around one piece of length ``w`` that is at least as good as any other feasible set with it.

    ``None`` if no such set of up to three pieces is provable. Every case stays provable while the
    set itself is in stock, since removing pieces only takes alternatives away.
    """
    rest = left.copy()
    rest[w] -= 1
    lengths = sorted(v for v, n in rest.items() if n > 0)
    room = capacity - w
    fitting = [v for v in lengths if v <= room]
    if not fitting:
        return [w]
    largest = fitting[-1]
    if largest == room:
        return [w, largest]  # an exact fill: whatever else stands with w can take its place
    smallest = [v for v in lengths[:3] for _ in range(min(rest[v], 3))][:3]
    if len(smallest) < 2 or smallest[0] + smallest[1] > room:
        return [w, largest]  # only one more piece fits
    if len(smallest) == 3 and sum(smallest) <= room:
        return None
    best = 0  # the largest sum of two pieces that fit
    for a in fitting:
        partner = next((b for b in reversed(fitting) if b <= a and a + b <= room and (b != a or rest[a] > 1)), 0)
        best = max(best, a + partner) if partner else best
    if largest >= best:
        return [w, largest]
    beside = next((b for b in reversed(fitting) if largest + b <= room and (b != largest or rest[b] > 1)), 0)
    if beside and sum(rest[v] for v in fitting if beside < v < largest) <= 1:
        return [w, largest, beside]  # any other pair has a piece no longer than either of these
    return None


def make_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Placed], int, int]:
    """Places for all pieces, the number of sequences, and how many of these the reduction fixed."""
    if any(w < 1 or w > capacity for w in histogram):
        raise ValueError("lengths must lie between 1 and the capacity")
    plan = _Plan(histogram)
    reducing = True
    while reducing:
        reducing = False
        for w in sorted(plan.left, reverse=True):
            while plan.left[w] and (found := dominating_set(plan.left, w, capacity)):
                plan.fix(found, plan.times(found))
                reducing = True
        plan.left = Counter({w: n for w, n in plan.left.items() if n > 0})
    fixed = plan.sequences

    open_ranges: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> ranges of sequences
    for w in sorted(plan.left, reverse=True):
        for room in sorted(r for r in open_ranges if r >= w):
            ranges, each = open_ranges.pop(room), room // w
            while ranges and plan.left[w]:
                first, many = ranges.pop()
                full = min(many, plan.left[w] // each)
                if full:
                    plan.place(w, full * each, first, each, capacity - room)
                    open_ranges[room - each * w].append((first, full))
                if full < many and (rest := plan.left[w]) and rest < each:
                    plan.place(w, rest, first + full, rest, capacity - room)
                    open_ranges[room - rest * w].append((first + full, 1))
                    full += 1
                if full < many:
                    ranges.append((first + full, many - full))
            if ranges:
                open_ranges[room] += ranges
            if not plan.left[w]:
                break
        if rest := plan.left[w]:
            each = capacity // w
            full, over = divmod(rest, each)
            if full:
                plan.place(w, full * each, plan.sequences, each, 0)
                open_ranges[capacity - each * w].append((plan.sequences, full))
                plan.sequences += full
            if over:
                plan.place(w, over, plan.sequences, over, 0)
                open_ranges[capacity - over * w].append((plan.sequences, 1))
                plan.sequences += 1
    return plan.placed, plan.sequences, fixed


def pack(pieces: DataFrame, order_by: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; sequences are gapless from offset 0.

    ``pieces`` should be a written table: it is read for the histogram and again for the ranks.
    ``order_by`` names columns that tell the pieces apart; equal rows are interchangeable. An empty table
    gives an empty table. Extra columns are carried along; ``sequence_id`` and ``offset`` are replaced.
    """
    n = pieces.count()
    buckets = LEAST_BUCKETS + n // BUCKET_ROWS
    dealt = pieces.drop("sequence_id", "offset").withColumn(
        "_bucket", F.pmod(F.xxhash64(*order_by), F.lit(buckets))
    )
    counts = staged_once(dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    placed, _, _ = make_plan(histogram, capacity)

    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        F.col("length").alias("_length"),
        F.col("_bucket").alias("_of"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"),
    )
    within = Window.partitionBy("length", "_bucket").orderBy(*order_by)
    ranked = dealt.withColumn("_rank", F.row_number().over(within) - 1).join(
        bases, (F.col("length") == F.col("_length")) & (F.col("_bucket") == F.col("_of")), "left"
    )
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_base")).drop("_bucket", "_length", "_of", "_base")

    # the plan: a few thousand ranges at most, whatever the number of pieces
    by_length: dict[int, np.ndarray] = {}
    for w in {p.length for p in placed}:
        rows = sorted((p.low, p.first, p.each, p.offset) for p in placed if p.length == w)
        by_length[w] = np.asarray(rows, dtype=np.int64)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        lengths, ranks = length.to_numpy(), rank.to_numpy()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for w in np.unique(lengths):
            mine = np.flatnonzero(lengths == w)
            rows = by_length[int(w)]
            found = rows[np.searchsorted(rows[:, 0], ranks[mine], side="right") - 1]
            past = ranks[mine] - found[:, 0]
            sequence[mine] = found[:, 1] + past // found[:, 2]
            offset[mine] = found[:, 3] + past % found[:, 2] * w
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    spot = ranked.withColumn("_place", place("length", "_rank"))
    return spot.withColumns({"sequence_id": F.col("_place.sequence_id"), "offset": F.col("_place.offset")}).drop(
        "_place", "_rank"
    )


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of the documents with their checksum and place; see ``encode_pieces`` and ``pack``."""
    pieces = encode_pieces(docs, id_col, text_col)
    sized = pieces.select(id_col, "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(staged_once(sized, "pieces"), [id_col, "piece", "ids_crc32"])
