"""Algebra on ``array<double>`` columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(vec: Column) -> Column:
    return vec.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def sq_norm(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x * x)


def norm(a: Column) -> Column:
    return F.sqrt(sq_norm(a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine; null when a side has zero length."""
    length = norm(a) * norm(b)
    return F.when(length > 0, dot(a, b) / length)


def sq_distance(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, x: acc + x
    )


def head(vec: Column, n: int) -> Column:
    return F.slice(vec, 1, n)


def span(vec: Column, start: int, stop: int) -> Column:
    """Elements ``start`` (0-based, inclusive) to ``stop`` (exclusive)."""
    return F.slice(vec, start + 1, stop - start)


def zeros(n: int) -> Column:
    return F.array_repeat(F.lit(0.0), n)


def binarise(vec: Column, at_least: float) -> Column:
    return F.transform(vec, lambda x: F.when(x >= at_least, 1.0).otherwise(0.0))


def joined(*vecs: Column) -> Column:
    return F.concat(*vecs)


def rounded(vec: Column, digits: int = 6) -> Column:
    return F.transform(vec, lambda x: F.round(x, digits) + F.lit(0.0))


def _render(x: Column) -> Column:
    text = F.format_string("%.5f", x)
    short = (
        F.when(text.endswith(".00000"), F.regexp_replace(text, r"\.00000$", ""))
        .when(text.endswith("000"), F.regexp_replace(text, r"000$", ""))
        .otherwise(text)
    )
    return F.when(short.isin("-0", "-0.00"), F.lit("0")).otherwise(short)


def format_vector(vec: Column, sep: str = "=") -> Column:
    """``%.5f`` per element, shortened to an integer or two decimals when the rest is zero.

    The rounded text decides *and* is printed, so 0.999999 renders as ``1``.
    """
    return F.array_join(F.transform(vec, _render), sep)


def literal_matrix(rows: Sequence[Sequence[float]]) -> Column:
    """A small constant matrix (for example cluster centres) as ``array<array<double>>``."""
    return F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in rows])
