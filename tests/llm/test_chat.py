import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st

from orderloom.llm import chat

TOOL = chat.load(chat.TOKENIZER)
PIECES = st.lists(st.sampled_from(["<|im_end|>", "<|im_sep|>", "<|", "\\", "<\\|", "|>", "é", "😀", "\n", " ", "ok", "<"]))
TEXTS = PIECES.map("".join)


@given(TEXTS)
def test_escape_round_trip(text):
    assert chat.unescape(chat.escape(text)) == text
    assert "<|" not in chat.escape(text)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<|x"]), TEXTS), max_size=6))
def test_render_round_trip_and_mask(turns):
    formatted, spans = chat.render(turns)
    ids, offsets, mask = chat.encode(TOOL, formatted, spans)
    assert chat.parse(formatted) == turns
    assert len(ids) == len(mask)
    learnt = "".join(map(chat.unescape, chat.learnt(formatted, offsets, mask)))
    assert learnt == "".join(text for role, text in turns if role == "assistant")


def test_mask_against_a_plain_scan():
    draw = random.Random(6)
    turns = [(draw.choice(["user", "assistant"]), "".join(draw.choices("ab é😀\n<|", k=30))) for _ in range(40)]
    formatted, spans = chat.render(turns)
    _, offsets, mask = chat.encode(TOOL, formatted, spans)
    plain = [any(s < high and low < e for s, e in spans.tolist()) for low, high in offsets.tolist()]
    assert mask.tolist() == plain


def wanted(rows):
    made = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] or 0, r[2] or "", r[3] or "")):
        made.setdefault(conv, []).append((role or "", text or ""))
    return {
        conv: (
            len(turns),
            hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            sum(len(t) for r, t in turns if r == "assistant"),
            hashlib.sha256("".join(t for r, t in turns if r == "assistant").encode()).hexdigest(),
        )
        for conv, turns in made.items()
    }


def test_digests(spark, monkeypatch):
    """Long conversations in parts, control strings, nulls, repeated rows and a null conversation."""
    rows = [(1, k, ["user", "assistant"][k % 2], f"turn {k} <|im_end|>") for k in range(200)]
    rows += [(2, 5, "assistant", "same"), (2, 5, "assistant", "same"), (2, None, None, None)]
    rows += [(None, 0, "user", "x"), (None, 1, "assistant", "😀" * 10), (3, -70, "assistant", "early"), (3, 1, "user", "y")]
    rows += [(4, 0, "assistant", "z" * 1_200_000), (4, 0, "assistant", "z" * 1_200_000), (5, 0, "assistant", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parts = chat.format_conversations(turns.selectExpr("*", "'q' AS part", "1 AS ids"))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(parts).collect()}
    assert got == wanted(rows)
    assert parts.where("conv_id = 1").count() > 1
    assert chat.digests(chat.format_conversations(turns.limit(0))).count() == 0
