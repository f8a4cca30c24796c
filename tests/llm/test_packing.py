import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from orderloom.llm import packing
from tests.llm.conftest import ODD_ROWS


def unpacked(placed):
    """Every piece of a plan as (sequence, offset, length)."""
    for p in placed:
        for i in range(p.high - p.low):
            yield p.first + i // p.each, p.offset + i % p.each * p.length, p.length


@pytest.mark.parametrize("seed", range(60))
def test_plans_are_gapless_and_complete(seed):
    draw = random.Random(seed)
    capacity = draw.choice([10, 20, 50])
    lengths = draw.sample(range(1, capacity + 1), draw.randint(1, capacity))
    histogram = {w: draw.randint(1, draw.choice([3, 40])) for w in lengths}
    placed, sequences, _ = packing.make_plan(histogram, capacity)
    filled = {}
    for sequence, offset, length in sorted(unpacked(placed)):
        assert offset == filled.get(sequence, 0)
        filled[sequence] = offset + length
    assert max(filled.values()) <= capacity
    assert sorted(filled) == list(range(sequences))
    assert Counter(length for *_, length in unpacked(placed)) == Counter(histogram)


def fewest(lengths, capacity):
    """Brute force: the fewest sequences, trying every open sequence for every piece."""
    best = len(lengths)

    def go(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(lengths):
            best = len(rooms)
            return
        for i, room in enumerate(rooms):
            if room >= lengths[k] and room not in rooms[:i]:
                go(k + 1, [*rooms[:i], room - lengths[k], *rooms[i + 1 :]])
        go(k + 1, [*rooms, capacity - lengths[k]])

    go(0, [])
    return best


@pytest.mark.parametrize("seed", range(80))
def test_reduction_keeps_an_optimum(seed):
    """What the dominance rules fix leaves an instance with which the optimum is still reached."""
    draw = random.Random(1000 + seed)
    lengths = sorted((draw.randint(2, 18) for _ in range(draw.randint(3, 10))), reverse=True)
    left, fixed = Counter(lengths), 0
    for w in sorted(set(lengths), reverse=True):
        while left[w] and (found := packing.dominating_set(+left, w, 20)):
            times = min(left[v] // n for v, n in Counter(found).items())
            left.subtract(Counter(found * times))
            fixed += times
    assert fixed + fewest(sorted(left.elements(), reverse=True), 20) == fewest(lengths, 20)


def test_ids_by_words_are_the_tokenizers(spark):
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    words = packing.WordIds(packing.TOKENIZER)
    texts = [
        "It's THE end...\n\n(of 2 lines)\tand a tab",
        "<|endoftext|> Ünïcode, naïve ΑΣ ΣΑΣ İstanbul ß ªº µ",
        "a\x1cb　c\u0085d ̈e   re's 'll", "Thnd*** $$$ foo's-bar_baz 12345 3.14", "", "  ",
    ]
    for text in texts:
        ids = np.frombuffer(packing.text_ids(words, text), "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_documents_are_packed_whole(spark, documents):
    rows = ODD_ROWS + [(100 + k, "word " * (k * 37 % 2500)) for k in range(60)]
    got = packing.pack_documents(documents(rows)).collect()
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    wanted = Counter()
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = np.asarray(ids[start : start + 2048], dtype="<u4")
            wanted[doc_id, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == wanted
    filled = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 2048
    assert len(filled) <= sum(r.length for r in got) // 2048 + 2


def test_nothing_to_pack(spark, documents):
    assert packing.pack_documents(documents([])).count() == 0
