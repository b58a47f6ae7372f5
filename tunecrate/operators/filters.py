"""Row filters and id rewriting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunecrate.functions import ids


def traffic_bucket(df: DataFrame, user: str, spec: str, modulus: int = 5) -> DataFrame:
    """Users of one gray-release group."""
    return df.where(ids.in_traffic_group(F.col(user), spec, modulus))


def good_bad_filter(items: DataFrame, good: DataFrame, bad: DataFrame, item: str = "item_id") -> DataFrame:
    """Keep white-listed items that are not black-listed."""
    return items.join(good.select(item).distinct(), item, "left_semi").join(
        bad.select(item).distinct(), item, "left_anti"
    )


def bernoulli_sample(df: DataFrame, fraction: float, seed: int, *key: str) -> DataFrame:
    """Reproducible sample without replacement, decided per key and not per partition.

    ``DataFrame.sample`` depends on how rows fall into partitions; hashing the key
    gives the same rows on any cluster size.
    """
    return df.where(ids.draw_int(seed, *[F.col(k) for k in key]) < F.lit(int(fraction * 2**32)))


def split_by_key(df: DataFrame, train: float, seed: int, *key: str) -> tuple[DataFrame, DataFrame]:
    """Complementary train / test parts, reproducible like :func:`bernoulli_sample`."""
    in_train = ids.draw_int(seed, *[F.col(k) for k in key]) < F.lit(int(train * 2**32))
    return df.where(in_train), df.where(~in_train)


def id_mapping(dim: DataFrame, local: str, global_: str, *keep: str) -> DataFrame:
    """Lookup from either id of a playlist to its global id: (any_id, global_id, keep...)."""
    pair = dim.select(local, global_, *keep)
    by_local = pair.where(F.col(local).isNotNull()).select(
        F.col(local).alias("any_id"), F.col(global_).alias("global_id"), *keep
    )
    by_global = pair.where(F.col(global_).isNotNull()).select(
        F.col(global_).alias("any_id"), F.col(global_).alias("global_id"), *keep
    )
    return by_local.unionByName(by_global).distinct()


def to_global_ids(facts: DataFrame, playlist: str, mapping: DataFrame) -> DataFrame:
    """Rewrite a playlist column to global ids and drop duplicate rows."""
    return (
        facts.join(mapping, facts[playlist] == mapping["any_id"])
        .drop("any_id", playlist)
        .distinct()
    )


def missing_pairs(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
    """Rows of ``a`` whose keys do not occur in ``b``."""
    return a.join(b.select(*keys).distinct(), list(keys), "left_anti")


def same_key(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner") -> DataFrame:
    """Join on keys compared without case and surrounding blanks."""
    return left.join(right, F.upper(F.trim(left[left_key])) == F.upper(F.trim(right[right_key])), how)
