"""Ordered lists per user in long form: (user_id, item_id, pos), pos from 1.

Arrays and ``k=a,b`` strings appear only at the sink. Positions come from lists whose
length is set by the caller (caps of pools, slots of a page), never from raw logs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunecrate.functions import ids
from tunecrate.operators.ranking_windows import numbered, top_n
from tunecrate.session import cut_lineage

USER, ITEM, POS = "user_id", "item_id", "pos"


def exclusion_set(*parts: DataFrame) -> DataFrame:
    """Distinct (user, item) over histories, earlier recommendations and dislikes."""
    out = parts[0].select(USER, ITEM)
    for part in parts[1:]:
        out = out.unionByName(part.select(USER, ITEM))
    return out.distinct()


def without(lists: DataFrame, excluded: DataFrame) -> DataFrame:
    return lists.join(excluded.select(USER, ITEM), [USER, ITEM], "left_anti")


def _known(excluded: DataFrame) -> DataFrame:
    """Exclusions that can match: in a join, null equals nothing."""
    return excluded.select(USER, ITEM).where(F.col(USER).isNotNull() & F.col(ITEM).isNotNull())


def _stack(pools: Sequence[DataFrame]) -> DataFrame:
    out = None
    for prio, pool in enumerate(pools):
        part = pool.select(USER, ITEM, F.col(POS).cast("bigint").alias(POS), F.lit(prio).alias("prio"))
        out = part if out is None else out.unionByName(part)
    return out


def first_seen(df: DataFrame, *order: str) -> DataFrame:
    """Order-preserving distinct: one row per (user, item) with its smallest order key.

    One or two non-negative integer order columns (the second below 2^40) are packed into
    one bigint, so the minimum stays a hash aggregation with map-side combine.
    """
    packed = F.col(order[0]).cast("bigint")
    if len(order) == 2:
        packed = F.shiftleft(packed, 40).bitwiseOR(F.col(order[1]).cast("bigint"))
    firsts = df.groupBy(USER, ITEM).agg(F.min(packed).alias("_first"))
    if len(order) == 1:
        return firsts.withColumnRenamed("_first", order[0])
    return firsts.select(
        USER, ITEM, F.shiftright("_first", 40).alias(order[0]), F.col("_first").bitwiseAND(F.lit(2**40 - 1)).alias(order[1])
    )


def pool_merge(pools: Sequence[DataFrame], excluded: DataFrame | None = None) -> DataFrame:
    """Concatenate pools in priority order, drop repeats and excluded items.

    One union and one aggregation on (user, item) replace a chain of outer joins; exclusions, which
    may hold repeats, go first in it. All rows travel once, to their user.
    """
    stacked = _stack(pools)
    if excluded is not None:
        stacked = stacked.unionByName(_known(excluded).withColumns({POS: F.lit(0).cast("bigint"), "prio": F.lit(-1)}))
    merged = first_seen(stacked.repartition(USER), "prio", POS).where(F.col("prio") >= 0)
    order = [F.col("prio"), F.col(POS), F.col(ITEM)]
    return numbered(merged, [USER], order, "_new").select(USER, ITEM, F.col("_new").alias(POS))


def fill_to_n(base: DataFrame, extra: DataFrame, n: int | None = 200) -> DataFrame:
    """Append ``extra`` after ``base`` until the list has ``n`` entries (``None``: append all).

    Repeats between the two lists stay, as both may carry the same item.
    """
    stacked = _stack([base, extra])
    order = [F.col("prio"), F.col(POS), F.col(ITEM)]
    ranked = (
        numbered(stacked, [USER], order, "_new")
        if n is None
        else top_n(stacked, [USER], order, n, "_new")
    )
    return ranked.select(USER, ITEM, F.col("_new").alias(POS))


def interleave(a: DataFrame, b: DataFrame, distinct: bool = False) -> DataFrame:
    """a1,b1,a2,b2,… for the users of ``a``; ``b`` is cut to the length of ``a``."""
    length = a.groupBy(USER).agg(F.max(POS).alias("_len"))
    left = a.select(USER, ITEM, (F.col(POS) * 2).alias("slot"))
    right = (
        b.join(length, USER)
        .where(F.col(POS) <= F.col("_len"))
        .select(USER, ITEM, (F.col(POS) * 2 + 1).alias("slot"))
    )
    both = left.unionByName(right)
    if distinct:
        both = first_seen(both, "slot")
    return numbered(both, [USER], [F.col("slot")], POS).select(USER, ITEM, POS)


def group_list_filter(
    group: DataFrame, recommended: DataFrame, played: DataFrame, ctr: DataFrame
) -> DataFrame:
    """Group recommendations minus everything the user already has, for users with a ctr list.

    Lists and exclusions, which may hold repeats, travel once, to their user.
    """
    rows = group.select(USER, ITEM, POS, F.lit(True).alias("_own"), F.lit(False).alias("_ctr"))
    none = F.lit(None).cast(group.schema[POS].dataType).alias(POS)
    for part, is_ctr in ((recommended, False), (played, False), (ctr, True)):
        rows = rows.unionByName(part.select(USER, ITEM, none, F.lit(False).alias("_own"), F.lit(is_ctr).alias("_ctr")))
    rows = rows.where(F.col(USER).isNotNull()).repartition(USER)
    rows = rows.withColumn("_served", F.max("_ctr").over(Window.partitionBy(USER))).where("_served")
    rows = rows.withColumn("_new_to", F.min("_own").over(Window.partitionBy(USER, ITEM)) | F.col(ITEM).isNull())  # null equals nothing
    kept = rows.where(F.col("_own") & F.col("_new_to"))
    return numbered(kept, [USER], [F.col(POS), F.col(ITEM)], "_new").select(
        USER, ITEM, F.col("_new").alias(POS)
    )


def shuffled_top(df: DataFrame, by: Sequence[str], n: int, seed: int, *key: str, rank: str = POS) -> DataFrame:
    """``n`` random rows per key in a reproducible order."""
    order = [ids.draw(seed, *[F.col(k) for k in key]), *[F.col(k) for k in key]]
    return top_n(df, by, order, n, rank)


def random_mix(
    lists: DataFrame, explore: DataFrame, seed: int = 1, slots: int = 200, head: int = 100
) -> DataFrame:
    """Mix a list with exploration items, round by round, up to ``slots`` picks, then distinct.

    Round r offers a random entry of the first ``head``, the r-th exploration item and the
    r-th entry from the end; offers past the end of a list are skipped. Only users with an
    exploration list take part.
    """
    explore = cut_lineage(explore.select(USER, ITEM, POS))
    users = explore.select(USER).distinct()
    listed = cut_lineage(lists.join(users, USER, "left_semi"))
    length = listed.groupBy(USER).agg(F.max(POS).alias("_len"))
    rounds = users.select(USER, F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("round"))
    offers = rounds.select(
        USER, "round", (F.pmod(ids.draw_int(seed, F.col(USER), F.col("round")), F.lit(head)) + 1).alias(POS)
    )
    # an explode counts as no larger than what it explodes, so offers would pass for small and be broadcast
    random_part = offers.hint("merge").join(listed, [USER, POS]).select(USER, ITEM, "round", F.lit(0).alias("part"))
    explore_part = explore.join(length, USER, "left_semi").select(
        USER, ITEM, (F.col(POS) - 1).alias("round"), F.lit(1).alias("part")
    )
    tail_part = (
        listed.join(length, USER)
        .where(F.col(POS) > 1)
        .select(USER, ITEM, (F.col("_len") - F.col(POS)).alias("round"), F.lit(2).alias("part"))
    )
    offered = random_part.unionByName(explore_part).unionByName(tail_part)
    order = [F.col("round"), F.col("part"), F.col(ITEM)]
    taken = top_n(offered, [USER], order, slots, "slot")
    return numbered(first_seen(taken, "slot"), [USER], [F.col("slot")], POS).select(USER, ITEM, POS)


def fresh_picks(
    candidates: DataFrame, invalid: DataFrame, excluded: DataFrame, n: int = 2, seed: int = 1
) -> DataFrame:
    """Up to ``n`` random candidates per user that are valid and not excluded."""
    usable = without(
        candidates.select(USER, ITEM).distinct().join(invalid.select(ITEM).distinct(), ITEM, "left_anti"),
        excluded,
    )
    return shuffled_top(usable, [USER], n, seed, USER, ITEM, rank="pick")


def tail_replace(lists: DataFrame, picks: DataFrame) -> DataFrame:
    """Overwrite the last slots with picks (pick 1 last, pick 2 before it) unless already listed."""
    lists = cut_lineage(lists.select(USER, ITEM, POS))
    length = lists.groupBy(USER).agg(F.max(POS).alias("_len"))
    new = (
        without(picks, lists)
        .join(length, USER)
        .select(USER, (F.col("_len") - F.col("pick") + 1).alias(POS), F.col(ITEM).alias("_new"))
        .where(F.col(POS) >= 1)
    )
    return lists.join(new, [USER, POS], "left").select(
        USER, F.coalesce("_new", ITEM).alias(ITEM), POS
    )


def format_list(lists: DataFrame, render: Column | None = None, out: str = "items") -> DataFrame:
    """One comma-joined line per user in list order. For lists of capped length."""
    text = F.col(ITEM).cast("string") if render is None else render
    packed = lists.groupBy(USER).agg(F.array_sort(F.collect_list(F.struct(F.col(POS), text.alias("t")))).alias("_l"))
    return packed.select(USER, F.array_join(F.transform("_l", lambda x: x["t"]), ",").alias(out))


def explode_list(df: DataFrame, items: str = "items") -> DataFrame:
    """(user, array) to long form."""
    return df.select(USER, F.posexplode(items).alias("_p", ITEM)).select(
        USER, ITEM, (F.col("_p") + 1).cast("bigint").alias(POS)
    )
