"""Identifiers: traffic groups, canonical playlist ids, seeded pseudo-random order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tail_digit(user: Column) -> Column:
    return F.substring(user, -1, 1)


def tail_group(user: Column, modulus: int) -> Column:
    """``<last digit>-<two digits before it, modulo>``; null for short or non-numeric ids."""
    pair = F.when(F.length(user) >= 3, F.substring(user, -3, 2)).try_cast("int")
    return F.concat(tail_digit(user), F.lit("-"), (pair % modulus).cast("string"))


def in_traffic_group(user: Column, spec: str, modulus: int = 5) -> Column:
    """Gray-release test: ``"all"``, ``"8"`` (last digit) or ``"8-1"`` (last digit and pair modulo)."""
    if spec == "all":
        return F.lit(True)
    if "-" in spec:
        return F.coalesce(tail_group(user, modulus) == spec, F.lit(False))
    return F.coalesce(tail_digit(user) == spec, F.lit(False))


def canonical_collection(playlist: Column) -> Column:
    """Versioned collection ids (``collection_2_<key>_<version>``) all map to version 0."""
    return F.when(
        playlist.rlike("collection_2"), F.regexp_replace(playlist, "_[^_]+$", "_0")
    ).otherwise(playlist)


def draw(seed: int, *cols: Column) -> Column:
    """Hex key whose order is a reproducible shuffle of the given columns."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols]))


def draw_int(seed: int, *cols: Column) -> Column:
    """First 32 bits of :func:`draw` as a non-negative bigint."""
    return F.conv(F.substring(draw(seed, *cols), 1, 8), 16, 10).cast("bigint")
