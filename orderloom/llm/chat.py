"""Chat formatting with loss masks aligned through token offsets.

A conversation is rendered whole and encoded once, with character offsets. The spans of its turns and of
its tokens are both sorted, so the tokens of a turn are found by binary search. Control strings are
single tokens of their own, so no token reaches across a turn's boundary; for the same reason a
conversation beyond ``PART_TURNS`` turns can be encoded in parts, with the same tokens.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import TOKENIZER_DIR, prepare

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
TOKENIZER = f"{TOKENIZER_DIR}/byte_bpe_50k.json"
LOSS_ROLE = "assistant"

#: A part of a conversation that one task renders and encodes: so many turns, and about so many characters.
PART_TURNS = 64
PART_CHARS = 1_000_000
#: Parts that are encoded and handed on together, if they have no more characters than that.
FRAME_PARTS = 256

_ESCAPED = re.compile(r"<(\\*)\|")
_UNESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No ``<|`` is left: a backslash is put into each, and one more into what looks like an escape."""
    return _ESCAPED.sub(lambda m: f"<\\{m[1]}|", text)


def unescape(text: str) -> str:
    return _UNESCAPED.sub(lambda m: f"<{m[1]}|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """The formatted text and the (start, end) of every text to learn, end mark not included."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEPARATOR}", escape(text)
        parts += (head, body, END)
        if role == LOSS_ROLE and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(END)
    return "".join(parts), np.asarray(spans, dtype=np.int64).reshape(-1, 2)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    turns = []
    for turn in formatted.split(START)[1:]:
        role, _, text = turn.removesuffix(END).partition(SEPARATOR)
        turns.append((unescape(role), unescape(text)))
    return turns


def load(path: str) -> object:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = False
    tokenizer.add_special_tokens([AddedToken(x, normalized=False, special=True) for x in (START, SEPARATOR, END)])
    return tokenizer


def masked(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Loss mask: a token counts if it lies in a span of a text to learn."""
    mask = np.zeros(len(offsets), bool)
    # tokens that share a character have the same or overlapping offsets, still in order
    first = np.searchsorted(offsets[:, 1], spans[:, 0], side="right")
    last = np.searchsorted(offsets[:, 0], spans[:, 1], side="left")
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        mask[a:b] = True
    return mask


def encode_all(tokenizer: object, formatted: list[str], spans: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, offsets and loss mask of each formatted text."""
    for made, mine in zip(tokenizer.encode_batch(formatted, add_special_tokens=False), spans, strict=True):
        offsets = np.fromiter(chain.from_iterable(made.offsets), np.int64).reshape(-1, 2)
        yield np.asarray(made.ids, np.int32), offsets, masked(offsets, mine)


def encode(tokenizer: object, formatted: str, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return next(encode_all(tokenizer, [formatted], [spans]))


def learnt(formatted: str, offsets: np.ndarray, mask: np.ndarray) -> list[str]:
    """The texts under the mask: the characters its tokens cover, each once, a string for each run."""
    found, low, high = [], 0, 0
    for start, end in offsets[mask].tolist():
        if start > high or not found and low == high:
            if high > low:
                found.append(formatted[low:high])
            low, high = start, end
        high = max(high, end)
    if high > low:
        found.append(formatted[low:high])
    return found


_FORMATTED = "conv_id long, part long, formatted string, ids array<int>, loss array<boolean>, learnt array<string>"


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows)))


def format_conversations(turns: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Parts of conversations (conv_id, part): formatted text, token ids, loss mask, texts under the mask.

    ``turns`` has conv_id, turn, role and text; rows of a conversation go by turn, then role and text
    (nulls first); null roles and texts are empty; repeated rows are turns of their own; a null conv_id
    is a conversation like any other. All but very long conversations are one part. Other columns are
    not read; an empty table gives an empty result.
    """
    prepare(turns.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, held, key, size, part = load(tokenizer), [], None, 0, 0
        done: list[tuple] = []
        chars = 0

        def encoded() -> pa.RecordBatch:
            convs, numbers, texts, spans = (list(x) for x in zip(*done, strict=True))
            ids, masks, learn = [], [], []
            for text, (mine, offsets, mask) in zip(texts, encode_all(tool, texts, spans), strict=True):
                ids.append(mine)
                masks.append(mask)
                learn.append(learnt(text, offsets, mask))
            columns = [
                pa.array(convs, pa.int64()), pa.array(numbers, pa.int64()), pa.array(texts, pa.string()),
                _lists(ids), _lists(masks), pa.array(learn, pa.list_(pa.string())),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", "formatted", "ids", "loss", "learnt"])

        for batch in batches:
            for conv, block, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                now = (conv, block)
                if held and (now != key or len(held) >= PART_TURNS or size >= PART_CHARS):
                    done.append((key[0], (key[1] << 24) + part, *render(held)))
                    chars += size
                    part = part + 1 if now == key else 0
                    held, size = [], 0
                    if len(done) >= FRAME_PARTS or chars >= PART_CHARS:
                        yield encoded()
                        done, chars = [], 0
                elif now != key:
                    part = 0
                key = now
                held.append((role, text))
                size += len(text)
        if held:
            done.append((key[0], (key[1] << 24) + part, *render(held)))
        if done:
            yield encoded()

    ordered = (
        turns.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.floor(F.coalesce(F.col("turn"), F.lit(0)) / PART_TURNS).cast("long").alias("_block"),
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .repartition("conv_id", "_block")
        .sortWithinPartitions("conv_id", "_block", "turn", "role", "text")
    )
    return ordered.select("conv_id", "_block", "role", "text").mapInArrow(run, _FORMATTED)


def digests(parts: DataFrame) -> DataFrame:
    """Per conversation: turns and texts under the mask, read back from the formatted parts, as digests.

    The parts of a conversation are streamed in order through running hashes, never held together.
    """

    kinds = {"conv_id": pa.int64(), "n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64()}
    kinds |= {"loss_sha256": pa.string(), "formatted_chars": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def row() -> tuple:
            return state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))

        for batch in batches:
            done = []
            for conv, formatted, texts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or conv != state[0]:
                    if state is not None:
                        done.append(row())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(formatted):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                for text in map(unescape, texts):
                    state[3] += len(text)
                    state[4].update(text.encode())
                state[5] += len(formatted)
            yield made(done)
        if state is not None:
            yield made([row()])

    ordered = (
        parts.select("conv_id", "part", "formatted", "learnt")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part")
    )
    return ordered.drop("part").mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
