"""Boolean trigram queries derived from regular expressions.

A query is a list of alternatives, each a set of trigrams that must all occur in the lower-cased text
wherever the expression matches. An empty alternative asks for nothing: the rule must scan all texts.
"""

from __future__ import annotations

import re
from re import _constants as C
from re import _parser

Query = list[frozenset[str]]

_MOST_STRINGS = 64
_ANY: Query = [frozenset()]


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _simplest(query: Query) -> Query:
    """Alternatives that ask for more than another one add nothing."""
    return sorted({a for a in query if not any(b < a for b in query)}, key=sorted)


def _both(a: Query, b: Query) -> Query:
    return _simplest([x | y for x in a for y in b])


def _of_strings(strings: set[str]) -> Query:
    return _simplest([trigrams(s) for s in strings])


def _strings(op: object, value: object) -> set[str] | None:
    """All strings that a parsed element matches, lower-cased, if they are few."""
    if op is C.LITERAL:
        return {chr(value).lower()}
    if op is C.IN:
        found: set[str] = set()
        for kind, x in value:
            if kind is C.LITERAL:
                found.add(chr(x).lower())
            elif kind is C.RANGE and x[1] - x[0] < 8:
                found |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return found if len(found) <= 8 else None
    if op is C.SUBPATTERN:
        return _all_strings(value[3])
    if op is C.BRANCH:
        parts = [_all_strings(x) for x in value[1]]
        return None if None in parts else set().union(*parts)
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and value[1] == 1:
        inner = _all_strings(value[2])
        return None if inner is None else inner | ({""} if value[0] == 0 else set())
    if op in (C.AT, C.ASSERT, C.ASSERT_NOT):
        return {""}
    return None


def _all_strings(parsed: object) -> set[str] | None:
    total = {""}
    for op, value in parsed:
        more = _strings(op, value)
        if more is None or len(total) * len(more) > _MOST_STRINGS:
            return None
        total = {a + b for a in total for b in more}
    return total


def _query(parsed: object) -> Query:
    query, run = _ANY, {""}
    for op, value in parsed:
        more = _strings(op, value)
        if more is not None and len(run) * len(more) <= _MOST_STRINGS:
            run = {a + b for a in run for b in more}
            continue
        query, run = _both(query, _of_strings(run)), {""}
        if more is not None:
            run = more
        elif op is C.SUBPATTERN:
            query = _both(query, _query(value[3]))
        elif op is C.BRANCH:
            query = _both(query, _simplest([a for x in value[1] for a in _query(x)]))
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and value[0] > 0:
            query = _both(query, _query(value[2]))
    return _both(query, _of_strings(run))


def query_of(pattern: str) -> Query:
    """The Boolean trigram query of a regular expression, over lower-cased text."""
    return _query(_parser.parse(pattern, re.IGNORECASE))
