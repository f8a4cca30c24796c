"""Positions of regular-expression matches as DataFrame expressions, in code points, end exclusive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 128

SPAN = "struct<start:int,end:int,match:string>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often and however deep ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _prefixes(values: Column, over: Callable[[Column], Column], join: Callable[[Column, Column], Column]) -> Column:
    """Running sums (or maxima) of a filled array, each element included: by blocks, so long arrays stay cheap."""

    def of(v: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / _BLOCK).cast("int"))
        return let(F.transform(blocks, lambda b: over(F.slice(v, b * _BLOCK + 1, F.lit(_BLOCK)))), lambda s: before(v, s))

    def before(v: Column, sums: Column) -> Column:
        starts = F.transform(
            F.sequence(F.lit(0), F.size(sums) - 1),
            lambda b: F.when(b > 0, over(F.slice(sums, F.lit(1), b))).otherwise(F.lit(0)),
        )
        return let(starts, lambda s: each(v, s))

    def each(v: Column, starts: Column) -> Column:
        return F.transform(
            v,
            lambda _, i: join(
                F.element_at(starts, F.floor(i / _BLOCK).cast("int") + 1),
                over(F.slice(v, i - i % _BLOCK + 1, i % _BLOCK + 1)),
            ),
        )

    return let(values, of)


def running_sums(values: Column) -> Column:
    return _prefixes(values, lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y), lambda x, y: x + y)


def running_maxima(values: Column) -> Column:
    return _prefixes(values, F.array_max, F.greatest)


def matches(text: Column, pattern: str, needs: Column | None = None) -> Column:
    """All leftmost non-overlapping matches; ``needs`` is a cheap condition without which there is none."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return found if needs is None else F.when(needs, found).otherwise(F.array().cast("array<string>"))


def located(text: Column, pattern: str, found: Column, context: int = 0) -> Column:
    """``found`` (of ``matches``) as spans: what stands between matches tells where each one starts.

    ``pattern`` must not match the empty string. With ``context`` spans also have ``before``, at most so many
    characters as far as the second match before, and ``after``, the next character: taken from the pieces, as a
    substring of the text would count its way there from the start of the text for every span.
    """
    shape = "struct<start:int,end:int,match:string,before:string,after:string>" if context else SPAN

    def of(f: Column) -> Column:
        return F.when(F.size(f) > 0, let(F.split(text, pattern, -1), lambda b: zipped(f, b))).otherwise(
            F.array().cast(f"array<{shape}>")
        )

    def piece(parts: Column, i: Column) -> Column:
        return F.coalesce(F.get(parts, i), F.lit(""))

    def around(f: Column, between: Column, i: Column) -> list[Column]:
        ahead = (piece(f, i - 2), piece(between, i - 1), piece(f, i - 1), piece(between, i))
        return [
            F.right(F.concat(*ahead), F.lit(context)).alias("before"),
            F.left(F.concat(piece(between, i + 1), piece(f, i + 1)), F.lit(1)).alias("after"),
        ]

    def with_context(f: Column, between: Column, spans: Column) -> Column:
        return F.transform(
            spans,
            lambda s, i: F.struct(*(s[x].alias(x) for x in ("start", "end", "match")), *around(f, between, i)),
        )

    def zipped(f: Column, between: Column) -> Column:
        steps = F.transform(
            f,
            lambda _, i: F.length(F.element_at(between, i + 1))
            + F.when(i > 0, F.length(F.element_at(f, F.greatest(i, F.lit(1))))).otherwise(0),
        )
        spans = F.zip_with(
            running_sums(steps),
            f,
            lambda start, m: F.struct(start.alias("start"), (start + F.length(m)).alias("end"), m.alias("match")),
        )
        return with_context(f, between, spans) if context else spans

    return let(found, of)


def labelled(spans: Column, kind: str, rank: int) -> Column:
    """Spans as (start, rank, end, kind), which sort by start and then by the kinds' order."""
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


LABELLED = "array<struct<start:int,rank:int,end:int,kind:string>>"


def listed(spans: Column) -> Column:
    """``kind:start:end`` of labelled spans in their order, comma-joined."""
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redacted(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with each span, or run of overlapping spans, replaced by ``mark``."""

    def of(ordered: Column) -> Column:
        ends = running_maxima(F.transform(ordered, lambda s: s["end"]))
        return F.when(F.size(ordered) > 0, let(ends, lambda covered: cut(ordered, covered))).otherwise(text)

    def cut(ordered: Column, covered: Column) -> Column:
        def before(i: Column) -> Column:
            return F.when(i > 0, F.element_at(covered, F.greatest(i, F.lit(1)))).otherwise(0)

        parts = F.transform(
            ordered,
            lambda s, i: F.when(
                (i == 0) | (s["start"] >= before(i)),
                F.concat(F.substring(text, before(i) + 1, s["start"] - before(i)), F.lit(mark)),
            ).otherwise(""),
        )
        return F.concat(F.array_join(parts, ""), F.substring(text, F.element_at(covered, -1) + 1, F.length(text)))

    return let(F.array_sort(spans), of)
