import itertools
import random
import time

import pytest
from pyspark.sql import types as T

from orderloom.llm import decontam
from tests.llm.conftest import ODD_ROWS

WORDS = [f"word{k}" for k in range(300)] + ["the", "of", "and", "to"] * 20


def prose(draw, n):
    return [draw.choice(WORDS) for _ in range(n)]


def items(spark, rows):
    schema = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
    return spark.createDataFrame(rows, schema).selectExpr("*", "1 AS doc_id", "'z' AS words")


def plain_leaks(docs, tests):
    """Brute force: every alignment of every pair of rows, every window."""
    found = set()
    for doc_id, text in docs:
        a = decontam.word_hashes(decontam.WordHashes(), text).tolist()
        for item_id, other in tests:
            b = decontam.word_hashes(decontam.WordHashes(), other).tolist()
            width = min(13, len(b))
            if len(b) < decontam.LEAST_WORDS:
                continue
            for shift in range(-len(b) + 1, len(a)):
                pairs = [a[shift + j] == b[j] for j in range(len(b)) if 0 <= shift + j < len(a)]
                if any(sum(pairs[k : k + width]) >= 0.8 * width for k in range(len(pairs) - width + 1)):
                    found.add((doc_id, item_id))
    return found


def test_leaks_against_brute_force(spark, documents):
    """Whole passages, passages at either end, and passages with one word in twelve replaced."""
    draw = random.Random(11)
    tests = [(k, " ".join(prose(draw, draw.randint(13, 60)))) for k in range(30)]
    docs = []
    for k in range(60):
        text = prose(draw, draw.randint(0, 200))
        if k % 2:
            passage = draw.choice(tests)[1].split()
            for at in range(draw.randrange(12), len(passage), 12):
                passage[at] = "Changed!"
            at = draw.choice([0, len(text), draw.randint(0, len(text))])
            text[at:at] = [w.upper() + "***" if k % 3 else w for w in passage]
        docs.append((k, " ".join(text)))
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(documents(docs), items(spark, tests)).collect()}
    wanted = plain_leaks(docs, tests)
    assert len(wanted) >= 30
    assert got == wanted
    kept = {r.doc_id for r in decontam.decontaminated(documents(docs), items(spark, tests)).collect()}
    assert kept == {k for k, _ in docs} - {k for k, _ in wanted}


def test_short_items_word_for_word(spark, documents):
    tests = items(spark, [(1, "one two three four five six"), (2, "too few"), (3, None), (4, "")])
    docs = documents([(1, "x One two, three four FIVE six y"), (2, "one two three four five"), (3, "too few"), (4, None)])
    assert [(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, tests).collect()] == [(1, 1)]


def leaks_of(texts, item):
    """The rows of ``texts`` that the item leaks into, as the tasks compare them."""
    words = decontam.WordHashes()
    mine = decontam.word_hashes(words, item)
    return {k for k, text in enumerate(texts) if decontam.overlap(decontam.word_hashes(words, text), mine)}


def test_items_in_partitions(spark, documents):
    draw = random.Random(2)
    tests = [(k, " ".join(prose(draw, 20))) for k in range(12)]
    docs = documents([(k, f"before {t} after") for k, t in tests]).repartition(5)
    many = items(spark, tests).repartition(7)
    got = sorted((r.doc_id, r.item_id) for r in decontam.find_leaks(docs, many).collect())
    assert got == [(k, k) for k in range(12)]
    assert decontam.decontaminated(docs, many).count() == 0


def test_odd_rows_and_empty_tables(spark, documents):
    passage = " ".join(f"word{k}" for k in range(20))
    tests = items(spark, [(1, passage), (1, passage), (None, passage), (2, None)])
    docs = documents([*ODD_ROWS, (8, passage), (8, passage), (None, passage)])
    got = [(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, tests).collect()]
    assert sorted(got, key=repr) == sorted([(8, 1)] * 4 + [(8, None)] * 2 + [(None, 1)] * 2 + [(None, None)], key=repr)
    kept = decontam.decontaminated(docs, tests)
    assert kept.columns == docs.columns
    assert kept.count() == len(ODD_ROWS)
    assert decontam.find_leaks(docs, items(spark, [])).count() == 0
    assert decontam.find_leaks(documents([]), tests).count() == 0
    assert decontam.decontaminated(documents([]), tests).count() == 0


@pytest.mark.parametrize("width", range(decontam.LEAST_WORDS, decontam.WINDOW_WORDS + 1))
def test_every_accepted_substitution_is_found(width):
    """All patterns of changed words that still agree in four fifths of a window, for each width of it."""
    item = [f"w{k}" for k in range(width)]
    most = max(k for k in range(width) if width - k >= decontam.SHARE * width)
    texts = []
    for k in range(most + 1):
        for changed in itertools.combinations(range(width), k):
            texts.append(" ".join(["before", *("x" if j in changed else w for j, w in enumerate(item)), "after"]))
    assert leaks_of(texts, " ".join(item)) == set(range(len(texts)))
    over = " ".join("x" if j <= most else w for j, w in enumerate(item))
    assert not leaks_of([over], " ".join(item))


def test_three_and_four_changed_words_of_fifteen():
    item = [f"w{k}" for k in range(15)]
    texts, wanted = [], set()
    for k in (3, 4):
        for changed in itertools.combinations(range(15), k):
            if any(sum(a <= j < a + 13 for j in changed) <= 2 for a in range(3)):
                wanted.add(len(texts))
            texts.append(" ".join("x" if j in changed else w for j, w in enumerate(item)))
    assert leaks_of(texts, " ".join(item)) == wanted
    assert wanted


def test_short_documents_quote_parts_of_a_long_item(spark, documents):
    """Each document is a few words of an item hundreds of words long, alone or between other documents."""
    item = [f"w{k}" for k in range(700)]
    quotes = [" ".join(item[at : at + 13 + at % 3]) for at in range(0, 680, 23)]
    assert leaks_of(quotes, " ".join(item)) == set(range(len(quotes)))
    docs = documents([row for k, t in enumerate(quotes) for row in ((k, t), (1000 + k, f"other {k}"), (2000 + k, None))])
    tests = items(spark, [(1, " ".join(item))])
    got = sorted(r.doc_id for r in decontam.find_leaks(docs, tests).collect())
    assert got == list(range(len(quotes)))
    kept = {r.doc_id for r in decontam.decontaminated(docs, tests).collect()}
    assert kept == {x + k for k in range(len(quotes)) for x in (1000, 2000)}


@pytest.mark.parametrize("unit", ["w", "w v", "w v u w v", " ".join(f"w{k}" for k in range(13))])
def test_repeated_words_on_both_sides(spark, documents, unit):
    """A long text and a long item of the same few words: time and memory follow their lengths, not the product of hits."""
    text, item = " ".join([unit] * 20_000).split()[:20_000], " ".join([unit] * 1000).split()[:1000]
    began = time.monotonic()
    docs = documents([(1, " ".join(text)), (2, "x " + " ".join(item[:500]) + " y"), (3, "nothing of it")])
    got = sorted(decontam.find_leaks(docs, items(spark, [(7, " ".join(item))])).collect())
    assert [(r.doc_id, r.words, r.agreeing) for r in got] == [(1, 1000, 1000), (2, 502, 500)]  # of a window's words two may differ
    assert time.monotonic() - began < 30


def test_longest_overlap_equals_brute_force():
    """First word, words and agreeing words over all alignments, the first of the longest."""
    draw = random.Random(6)
    for _ in range(150):
        vocabulary = [f"w{k}" for k in range(draw.choice([2, 4, 300]))]
        item = [draw.choice(vocabulary) for _ in range(draw.randint(5, 40))]
        text = [draw.choice(vocabulary) for _ in range(draw.randint(0, 60))]
        at = draw.randint(0, len(text))
        text[at:at] = [w if draw.random() < 0.9 else "x" for w in item[draw.randint(0, 5) :]]
        a, b = (decontam.word_hashes(decontam.WordHashes(), " ".join(x)) for x in (text, item))
        width, best = min(13, len(b)), None
        for start in range(-len(b) + 1, len(a)):
            low, high = max(0, start), min(len(a), start + len(b))
            agree = (a[low:high] == b[low - start : high - start]).tolist()
            good = [k for k in range(len(agree) - width + 1) if sum(agree[k : k + width]) >= 0.8 * width]
            if good:
                first, last = good[0], good[-1] + width
                found = (low + first, last - first, sum(agree[first:last]))
                if best is None or found[1:] > best[1:]:
                    best = found
        assert decontam.overlap(a, b) == best


def test_nothing_of_the_tables_goes_to_the_driver(spark, documents, monkeypatch):
    """Items, texts and hits stay in Spark: what is collected is the window widths and the filter, whose sizes are fixed."""
    collected = []
    from pyspark.sql.classic.dataframe import DataFrame

    for name in ("collect", "toArrow", "toPandas"):
        old = getattr(DataFrame, name)
        monkeypatch.setattr(DataFrame, name, lambda df, *a, old=old: (collected.append(df.columns), old(df, *a))[1])
    draw = random.Random(3)
    tests = [(k, " ".join(prose(draw, 30))) for k in range(20)]
    found = decontam.find_leaks(documents([(k, f"a {t} b") for k, t in tests]), items(spark, tests))
    assert collected == [["width"], ["block", "bits"]]
    assert found.count() >= 20
