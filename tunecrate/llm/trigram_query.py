"""Boolean trigram queries of regular expressions.

A query is a set of alternatives, each a set of trigrams that a text must have (in lower
case) for the expression to match. The alternative without trigrams demands nothing: an
expression with it has no mandatory trigram and scans every text.
"""

from __future__ import annotations

from re import _parser as parser  # the standard library's own parse tree

Query = frozenset  # of frozensets of trigrams
ANY: Query = frozenset({frozenset()})
MOST_STRINGS = 64


def _absorbed(query: set[frozenset]) -> Query:
    return frozenset(a for a in query if not any(b < a for b in query))


def both(a: Query, b: Query) -> Query:
    return _absorbed({x | y for x in a for y in b})


def either(a: Query, b: Query) -> Query:
    return _absorbed(set(a | b))


def of_strings(strings: set[str]) -> Query:
    return _absorbed({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})


def _choices(items: list) -> set[str] | None:
    """Characters of a small class in lower case, or None."""
    found: set[str] = set()
    for kind, value in items:
        if str(kind) == "LITERAL":
            found.add(chr(value).lower())
        elif str(kind) == "RANGE" and value[1] - value[0] < 8:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= 8 else None


def _joined(heads: set[str], tails: set[str]) -> set[str] | None:
    return {h + t for h in heads for t in tails} if len(heads) * len(tails) <= MOST_STRINGS else None


def _strings(tree) -> set[str] | None:
    """All strings that a finite part of an expression matches, or None."""
    found = {""}
    for kind, value in tree:
        kind = str(kind)
        if kind == "LITERAL":
            more = {chr(value).lower()}
        elif kind == "IN":
            more = _choices(value)
        elif kind == "SUBPATTERN":
            more = _strings(value[-1])
        elif kind == "BRANCH":
            options = [_strings(t) for t in value[1]]
            more = None if None in options else set().union(*options)
        elif kind == "MAX_REPEAT" and value[1] == 1:
            one = _strings(value[2])
            more = one and one | ({""} if value[0] == 0 else set())
        else:
            more = None
        found = None if more is None else _joined(found, more)
        if found is None:
            return None
    return found


def _walk(tree) -> Query:
    query, run = ANY, {""}
    for item in tree:
        more = _strings([item])
        joined = None if more is None else _joined(run, more)
        if joined is not None:
            run = joined
            continue
        query, run = both(query, of_strings(run)), {""}
        kind, value = str(item[0]), item[1]
        if more is not None:
            run = more
        elif kind == "SUBPATTERN":
            query = both(query, _walk(value[-1]))
        elif kind == "BRANCH":
            options = [_walk(t) for t in value[1]]
            joined_options = options[0]
            for option in options[1:]:
                joined_options = either(joined_options, option)
            query = both(query, joined_options)
        elif kind == "MAX_REPEAT" and value[0] >= 1:
            query = both(query, _walk(value[2]))
    return both(query, of_strings(run))


def trigram_query(expression: str) -> Query:
    """The query of a regular expression: a match implies that one alternative's trigrams are all in the text."""
    return _walk(parser.parse(expression))
