"""Implicit matrix factorisation, fold-in of new users, factor-based ranking."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunecrate.functions import measures, vectors
from tunecrate.operators.filters import bernoulli_sample, good_bad_filter
from tunecrate.operators.frames import result_frame
from tunecrate.operators.lists import ITEM, POS, USER, without
from tunecrate.operators.ranking_windows import capped_top_n, dense_ids, numbered, rank_cutoff, running_total
from tunecrate.session import cut_lineage, ensure_checkpoint_dir

ROWS_PER_PART = 4096
MERGE = 64
RATINGS_PER_TASK = 20_000
SYSTEM_CELLS = 1 << 22  # matrix entries solved at a time
RATINGS_PER_BLOCK = 20_000_000  # of the trainer, some 600 MB in its making; a factor travels to every block with a rating of it
LISTED_USERS = 1024  # users whose candidates are ranked in one task
RANGES = 64  # of keys, numbered one by one
HOT_BLOCK = 20000
USER_BLOCK = 16384
PRODUCT_ROWS = 256  # users of a block scored at a time
FIRST_ITEMS = 256  # items scored before the first look at the bounds; the step doubles
ROUNDING = 1e-8  # scores order after rounding to nine digits


@dataclass(frozen=True)
class FactorParams:
    """Training settings; ``parse`` reads the ``alpha_lambda_rank_iterations`` form."""

    alpha: float
    reg: float
    rank: int
    iterations: int

    @staticmethod
    def parse(text: str) -> "FactorParams":
        alpha, reg, rank, iterations = text.split("_")[:4]
        return FactorParams(float(alpha), float(reg), int(rank), int(iterations))


def item_idf(plays: DataFrame) -> DataFrame:
    """ln(users / users of the item)."""
    players = plays.groupBy(ITEM).agg(F.countDistinct(USER).alias("n"))
    total = plays.agg(F.countDistinct(USER).alias("n"))
    return players.select(ITEM, F.log(total.scalar() / F.col("n")).alias("idf"))


def idf_rating(plays: DataFrame, idf: DataFrame) -> DataFrame:
    """(user, item, rating) with ``log10(dur/0.01 + 1) * idf``."""
    return plays.join(idf, ITEM).select(
        USER, ITEM, measures.song_rating(F.col("dur"), F.col("idf")).alias("rating")
    )


def train_als(
    ratings: DataFrame, params: FactorParams, seed: int = 1, blocks: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(user factors, item factors) as (id, factor array); ids of any type.

    ``blocks``: partitions of either side, by default one per ``RATINGS_PER_BLOCK`` ratings.

    Ids are numbered without collecting them, by :func:`_block_ids`. The ratings are written once, as
    they are counted, numbered and trained on.
    """
    ensure_checkpoint_dir(ratings.sparkSession)
    ratings = cut_lineage(ratings.where(F.col("rating") > 0).select(USER, ITEM, F.col("rating").cast("float")))
    total = ratings.count()
    blocks = blocks or max(10, -(-total // RATINGS_PER_BLOCK))
    users = cut_lineage(_block_ids(ratings, USER, "u", blocks, total))
    items = cut_lineage(_block_ids(ratings, ITEM, "i", blocks, total))
    indexed = ratings.join(users, USER).join(items, ITEM).select("u", "i", "rating")
    model = ALS(
        numUserBlocks=blocks, numItemBlocks=blocks, userCol="u", itemCol="i", ratingCol="rating", implicitPrefs=True, alpha=params.alpha,
        regParam=params.reg, rank=params.rank, maxIter=params.iterations, seed=seed, checkpointInterval=5,
    ).fit(indexed)
    as_doubles = vectors.doubles(F.col("features")).alias("factor")
    return (
        model.userFactors.withColumnRenamed("id", "u").join(users, "u").select(USER, as_doubles),
        model.itemFactors.withColumnRenamed("id", "i").join(items, "i").select(ITEM, as_doubles),
    )


def _block_ids(ratings: DataFrame, key: str, out: str, blocks: int, total: int) -> DataFrame:
    """Distinct keys with a number whose remainder by ``blocks`` is the trainer's block: ranges of keys with equal shares of the ratings.

    Users and items that came into use together mostly have ids near each other, so a range of
    users needs the factors of few ranges of items.
    """
    counted = ratings.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_r"))
    if total >= 1 << 30:  # numbers with gaps might pass the trainer's ints
        return dense_ids(ratings, key, out)
    ranged = cut_lineage(counted.repartitionByRange(RANGES, key).withColumn("_b", F.spark_partition_id()))
    upto = running_total(ranged, [], "_b", [F.col(key)], F.col("_r"), "_upto")
    block = F.least(F.lit(blocks - 1), F.floor((F.col("_upto") - F.col("_r")) * blocks / total))
    placed = running_total(upto.withColumn("_block", block), ["_block"], "_b", [F.col(key)], F.lit(1), "_n")
    return placed.select(key, ((F.col("_n") - 1) * blocks + F.col("_block")).cast("int").alias(out))


def implicit_als(
    plays: DataFrame, idf: DataFrame, params: FactorParams, seed: int = 1, finish_on_items: bool = True
) -> DataFrame:
    """(item_id, factor): implicit ALS on IDF-weighted durations.

    The trainer ends with a user step. With ``finish_on_items`` users and items change
    places, so that it ends with the items, optimal for the final users.
    """
    ratings = idf_rating(plays, idf)
    if not finish_on_items:
        return train_als(ratings, params, seed)[1]
    flipped = ratings.select(F.col(ITEM).alias(USER), F.col(USER).alias(ITEM), "rating")
    return train_als(flipped, params, seed)[0].withColumnRenamed(USER, ITEM)


def als_factors_norm(
    ratings: DataFrame, rank: int, iterations: int, fraction: float = 1.0, seed: int = 1,
    alpha: float = 40.0, reg: float = 0.01,
) -> DataFrame:
    """(kind, id, norm, factor) of users and items, trained on a seeded sample of the ratings."""
    sampled = ratings if fraction >= 1 else bernoulli_sample(ratings, fraction, seed, USER, ITEM)
    users, items = train_als(sampled, FactorParams(alpha, reg, rank, iterations), seed)
    both = users.select(F.lit("user").alias("kind"), F.col(USER).alias("id"), "factor").unionByName(
        items.select(F.lit("item").alias("kind"), F.col(ITEM).alias("id"), "factor")
    )
    return both.select("kind", "id", vectors.norm(F.col("factor")).alias("norm"), "factor")


def gram_matrix(factors: DataFrame, factor: str = "factor") -> DataFrame:
    """Sum of y y^T as rows (i, j, value): one partial matrix per task, then a small sum."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            if len(pdf):
                y = np.stack(pdf[factor].to_numpy())
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            i, j = np.indices(total.shape)
            yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "value": total.ravel()})

    cells = factors.select(factor).mapInPandas(partial, "i int, j int, value double")
    return cells.groupBy("i", "j").agg(F.sum("value").alias("value"))


def _collect_gram(factors: DataFrame) -> np.ndarray:
    """The rank x rank Gram matrix on the driver (its size depends on the rank only)."""
    cells = gram_matrix(factors).toPandas()
    rank = int(cells["i"].max()) + 1 if len(cells) else 0
    gram = np.zeros((rank, rank))
    gram[cells["i"], cells["j"]] = cells["value"]
    return gram


def solve_factors(ratings: DataFrame, factors: DataFrame, alpha: float, reg: float) -> DataFrame:
    """One regularised solve per user against fixed item factors.

    (Y'Y + Y'(C - I)Y + reg * n * I) x = Y'C 1 with c = 1 + alpha * rating. Users are solved in
    blocks of about ``RATINGS_PER_TASK`` ratings; a block gets each factor it needs once. A user with more
    than ``ROWS_PER_PART`` rows is reduced to partial sums over parts of its rows, on many
    tasks; partial sums are merged ``MERGE`` at a time until one step can take them.
    """
    gram = _collect_gram(factors)
    rank = gram.shape[0]
    upper = np.triu_indices(rank)
    user_type = ratings.schema[USER].dataType.simpleString()

    rated = cut_lineage(ratings.join(factors.select(ITEM), ITEM, "left_semi").select(USER, ITEM, "rating"))
    busy = (
        rated.groupBy(USER)
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > ROWS_PER_PART)
        .select(USER, F.ceil(F.col("n") / ROWS_PER_PART).alias("parts"))
    )
    busy = cut_lineage(busy)
    most_parts = busy.agg(F.max("parts")).first()[0] or 1

    def sums(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        y = np.stack(pdf["factor"].to_numpy())
        extra = alpha * pdf["rating"].to_numpy()
        return (y * extra[:, None]).T @ y, y.T @ (1.0 + extra)

    def solution(user, n: int, lhs: np.ndarray, rhs: np.ndarray) -> pd.DataFrame:
        x = np.linalg.solve(gram + lhs + reg * n * np.eye(rank), rhs)
        return pd.DataFrame({USER: [user], "factor": [x]})

    def solve_block(mine: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        """All users of a block, solved in stacks of bounded size. Each item factor came once."""
        if not len(mine):
            return pd.DataFrame({USER: [], "factor": []})
        mine = mine.sort_values([USER, ITEM], kind="stable")
        place = pd.Index(items["_item"]).get_indexer(mine[ITEM])
        y, extra = np.stack(items["factor"].to_numpy())[place], alpha * mine["rating"].to_numpy()
        starts = np.flatnonzero(np.append(True, mine[USER].to_numpy()[1:] != mine[USER].to_numpy()[:-1]))
        ends = np.append(starts[1:], len(mine))
        rhs = np.add.reduceat(y * (1.0 + extra)[:, None], starts)
        solved: list[np.ndarray] = []
        step = max(1, SYSTEM_CELLS // rank**2)
        for first in range(0, len(starts), step):
            own = slice(first, first + step)
            lhs = np.stack([(y[i:j] * extra[i:j, None]).T @ y[i:j] for i, j in zip(starts[own], ends[own])])
            lhs += gram + (reg * (ends - starts)[own])[:, None, None] * np.eye(rank)
            solved += list(np.linalg.solve(lhs, rhs[own, :, None])[:, :, 0])
        return result_frame({USER: list(mine[USER].to_numpy()[starts]), "factor": solved})

    def partial(pdf: pd.DataFrame) -> pd.DataFrame:
        lhs, rhs = sums(pdf)
        return pd.DataFrame({USER: [pdf[USER].iloc[0]], "part": [pdf["part"].iloc[0]], "n": [len(pdf)], "lhs": [lhs[upper]], "rhs": [rhs]})

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        total = {c: [np.sum(np.stack(pdf[c].to_numpy()), axis=0)] for c in ("lhs", "rhs")}
        return pd.DataFrame({USER: [pdf[USER].iloc[0]], "part": [pdf["part"].iloc[0]], "n": [int(pdf["n"].sum())], **total})

    def solve_parts(pdf: pd.DataFrame) -> pd.DataFrame:
        lhs = np.zeros((rank, rank))
        lhs[upper] = np.sum(np.stack(pdf["lhs"].to_numpy()), axis=0)
        lhs = lhs + np.triu(lhs, 1).T
        return solution(pdf[USER].iloc[0], int(pdf["n"].sum()), lhs, np.sum(np.stack(pdf["rhs"].to_numpy()), axis=0))

    solved = f"{USER} {user_type}, factor array<double>"
    blocks = max(1, -(-rated.count() // RATINGS_PER_TASK))
    placed = rated.join(busy, USER, "left_anti").withColumn("ub", F.pmod(F.xxhash64(USER), F.lit(blocks)))
    needed = placed.select("ub", ITEM).distinct().join(factors.select(ITEM, "factor"), ITEM)
    ordinary = placed.groupBy("ub").cogroup(needed.select("ub", ITEM, "factor").toDF("_ub", "_item", "factor").groupBy("_ub")).applyInPandas(
        solve_block, solved
    )
    split = rated.join(busy, USER).join(factors.select(ITEM, "factor"), ITEM).withColumn("part", F.pmod(F.xxhash64(ITEM), F.col("parts")))
    summed = f"{USER} {user_type}, part bigint, n bigint, lhs array<double>, rhs array<double>"
    pieces = split.select(USER, "part", ITEM, "rating", "factor").groupBy(USER, "part").applyInPandas(partial, summed)
    while most_parts > MERGE:
        most_parts = -(-most_parts // MERGE)
        pieces = pieces.withColumn("part", F.col("part") % most_parts).groupBy(USER, "part").applyInPandas(merged, summed)
    return ordinary.unionByName(pieces.groupBy(USER).applyInPandas(solve_parts, solved))


def optimality_gap(ratings: DataFrame, factors: DataFrame, solved: DataFrame, alpha: float, reg: float) -> DataFrame:
    """(user_id, gap): how far solved factors are from solving their system, relative to its right side."""
    gram = _collect_gram(factors)
    rank = gram.shape[0]
    joined = ratings.join(factors, ITEM).join(solved.select(USER, F.col("factor").alias("_x")), USER)
    extra = alpha * F.col("rating")
    pull = extra * vectors.dot(F.col("factor"), F.col("_x"))
    each = [F.sum(pull * F.col("factor")[i]) for i in range(rank)] + [F.sum((1 + extra) * F.col("factor")[i]) for i in range(rank)]
    sums = joined.groupBy(USER).agg(F.count("*").alias("n"), F.first("_x").alias("x"), F.array(*each).alias("s"))
    level = F.transform(vectors.literal_matrix(gram.tolist()), lambda row: vectors.dot(row, F.col("x")))
    left = F.zip_with(F.zip_with(level, F.slice("s", 1, rank), lambda a, b: a + b), F.col("x"), lambda a, x: a + reg * F.col("n") * x)
    right = F.slice("s", rank + 1, rank)
    return sums.select(USER, (vectors.norm(F.zip_with(left, right, lambda a, b: a - b)) / vectors.norm(right)).alias("gap"))


def als_fold_in(
    plays: DataFrame, item_factors: DataFrame, idf: DataFrame, alpha: float, reg: float, max_dur: float = 30.0
) -> DataFrame:
    """(user_id, factor) of new users; durations are clamped, items without factors are skipped."""
    clamped = plays.withColumn("dur", measures.clamp(F.col("dur"), max_dur))
    return solve_factors(idf_rating(clamped, idf), item_factors, alpha, reg)


def hot_by_norm(item_factors: DataFrame, n: int = 50000) -> DataFrame:
    """Items whose squared factor norm reaches the ``n``-th largest, ties kept."""
    with_norm = item_factors.withColumn("sq_norm", F.round(vectors.sq_norm(F.col("factor")), 9))
    return rank_cutoff(with_norm, ITEM, "sq_norm", n)


def _best_by_falling_norm(
    users: np.ndarray, barred: list, least: np.ndarray, vectors_: np.ndarray, norms: np.ndarray, codes: np.ndarray, cap: int, length: int
) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """Per user the (item rows, scores) that can still be listed, and the number of products made.

    Items come by falling norm, ties by id. A user takes part as long as |user| x |next item|
    reaches the user's last place: the ``length``-th best score so far with ``cap`` a singer.
    """
    sizes = np.sqrt(np.einsum("ij,ij->i", users, users))
    found = [(np.zeros(0, np.int64), np.zeros(0))] * len(users)
    least, products, low, step = least.copy(), 0, 0, FIRST_ITEMS
    while low < len(norms):
        alive = np.flatnonzero(sizes * norms[low] + ROUNDING >= least)
        if not len(alive):
            break
        high = min(len(norms), low + step)
        scores = np.round(users[alive] @ vectors_[low:high].T, 9)
        products += scores.size
        for row, user in enumerate(alive.tolist()):
            at = np.flatnonzero(scores[row] >= least[user])
            if barred[user] is not None:
                at = at[~np.isin(at + low, barred[user])]
            if not len(at):
                continue
            rows = np.concatenate([found[user][0], at + low])
            score = np.concatenate([found[user][1], scores[row][at]])
            order = np.argsort(-score, kind="stable")  # a stable order would need ids: ties at the end are all kept
            singer = codes[rows[order]]
            by = np.argsort(singer, kind="stable")
            starts = np.flatnonzero(np.append(True, np.diff(singer[by]) != 0))
            nth = np.empty(len(by), np.int64)
            nth[by] = np.arange(len(by)) - np.repeat(starts, np.diff(np.append(starts, len(by))))
            capped = score[order][nth < cap]
            if len(capped) >= length:
                least[user] = max(least[user], capped[length - 1])
            keep = score >= least[user]
            found[user] = (rows[keep], score[keep])
        low, step = high, step * 2
    return found, products


def _hot_lists(
    users: DataFrame, hot: DataFrame, excluded: DataFrame, singers: DataFrame, cap: int, length: int, products=None
) -> DataFrame:
    """Ranked lists from the hot pool for users with few candidates. users: (user_id, factor, length).

    Items fall into blocks of falling norm. All users meet the first block, which gives them a
    last place; a later block is met only by the users whose norm times its largest norm can
    still reach theirs, and inside a block the same bound ends a user's walk. Ties at the norm
    cut may make the hot pool larger than planned and only add blocks.
    """
    hot = cut_lineage(
        hot.join(singers.select(ITEM, "singer"), ITEM, "left").select(
            ITEM, F.coalesce("singer", F.lit("Unknown")).alias("singer"), vectors.doubles(F.col("factor")).alias("factor"),
            F.sqrt(vectors.sq_norm(F.col("factor"))).alias("norm"),
        )
    )
    users = cut_lineage(users.select(USER, vectors.doubles(F.col("factor")).alias("factor"), F.sqrt(vectors.sq_norm(F.col("factor"))).alias("size")))
    hot_blocks = max(1, -(-hot.count() // HOT_BLOCK))
    user_blocks = max(1, -(-users.count() // USER_BLOCK))
    user_type, item_type = (users.schema[USER].dataType.simpleString(), hot.schema[ITEM].dataType.simpleString())
    # the range partitions are the blocks; the id splits items of one norm
    ranged = hot.repartitionByRange(hot_blocks, F.desc("norm"), F.col(ITEM)) if hot_blocks > 1 else hot.repartition(1)
    placed = cut_lineage(ranged.withColumn("hb", F.spark_partition_id().cast("bigint")))
    tops = {r["hb"]: r["top"] for r in placed.groupBy("hb").agg(F.max("norm").alias("top")).collect()}
    barred = (
        excluded.join(placed.select(ITEM, "hb"), ITEM)
        .select(USER, "hb", ITEM).distinct()
        .groupBy(USER, "hb").agg(F.collect_list(ITEM).alias("barred"))  # at most one hot block
    )

    def rank_block(u: pd.DataFrame, h: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {USER: [], ITEM: [], "singer": [], "score": []}
        if len(u) and len(h):
            h = h.sort_values(["norm", ITEM], ascending=[False, True], kind="stable", ignore_index=True)
            names, items, norms = h["singer"].to_numpy(), h[ITEM].to_numpy(), h["norm"].to_numpy()
            codes, matrix = pd.factorize(names)[0], np.stack(h["factor"].to_numpy())
            place = pd.Series(np.arange(len(items)), index=items)
            users_, factors_, least = u[USER].to_numpy(), np.stack(u["factor"].to_numpy()), u["least"].to_numpy()
            gone = [None if b is None else place.reindex(b).dropna().to_numpy().astype(np.int64) for b in u["barred"].to_numpy()]
            for at in range(0, len(u), PRODUCT_ROWS):
                part = slice(at, at + PRODUCT_ROWS)
                found, made = _best_by_falling_norm(factors_[part], gone[part], least[part], matrix, norms, codes, cap, length)
                if products is not None:
                    products.add(made)
                for user, (rows, scores) in zip(users_[part], found):
                    out[USER] += [user] * len(rows)
                    out[ITEM] += list(items[rows])
                    out["singer"] += list(names[rows])
                    out["score"] += list(scores)
        return result_frame(out)

    def met(asked: DataFrame, blocks: list[int]) -> DataFrame:
        """Lists of ``asked`` (user, factor, least, hb) from the named blocks."""
        left = asked.join(barred, [USER, "hb"], "left").withColumn("ub", F.pmod(F.xxhash64(USER), F.lit(user_blocks)))
        right = placed.where(F.col("hb").isin(blocks)).withColumn(
            "ub", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(user_blocks - 1).cast("bigint")))
        )
        return (
            left.select("hb", "ub", USER, "factor", "least", "barred").groupBy("hb", "ub")
            .cogroup(right.select("hb", "ub", ITEM, "singer", "factor", "norm").groupBy("hb", "ub"))
            .applyInPandas(rank_block, f"{USER} {user_type}, {ITEM} {item_type}, singer string, score double")
        )

    first, later = min(tops, default=0), sorted(tops)[1:]
    lists = met(users.withColumn("hb", F.lit(first).cast("bigint")).withColumn("least", F.lit(float("-inf"))), [first])
    if not later:
        return lists
    lists = cut_lineage(lists)
    places = capped_top_n(lists, [USER], "singer", [F.desc("score"), F.col(ITEM)], cap, length)
    last = places.where(F.col("rank") == length).select(USER, F.col("score").alias("least"))
    open_blocks = F.array(*[F.struct(F.lit(b).cast("bigint").alias("hb"), F.lit(tops[b]).alias("top")) for b in later])
    asked = users.join(last, USER, "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    reaching = F.filter(open_blocks, lambda b: F.col("size") * b["top"] + ROUNDING >= F.col("least"))
    asked = asked.withColumn("hb", F.explode(F.transform(reaching, lambda b: b["hb"])))
    return lists.unionByName(met(asked, later))


def _candidate_lists(
    users: DataFrame, candidates: DataFrame, items: DataFrame, excluded: DataFrame, singers: DataFrame, least: int, cap: int, length: int
) -> DataFrame:
    """(user_id, item_id, singer, score): the best candidates of the users that have more than ``least`` usable ones.

    Candidates travel as one list per user, to blocks of users with ids near each other. A block gets each
    item factor it needs once, so no factor travels per candidate.
    """
    user_type, item_type = (users.schema[USER].dataType.simpleString(), items.schema[ITEM].dataType.simpleString())
    users = cut_lineage(users.select(USER, vectors.doubles(F.col("factor")).alias("factor")))
    blocks = max(1, -(-users.count() // LISTED_USERS))
    seated = cut_lineage(users.repartitionByRange(blocks, USER).withColumn("ub", F.spark_partition_id()))
    gone = excluded.groupBy(USER).agg(F.collect_list(ITEM).alias("_gone"))
    lists = candidates.groupBy(USER).agg(F.array_distinct(F.collect_list(ITEM)).alias("listed")).join(gone, USER, "left")
    kept = F.when(F.col("_gone").isNull(), F.col("listed")).otherwise(F.array_except("listed", "_gone"))
    lists = lists.select(USER, kept.alias("listed")).where(F.size("listed") > least).join(seated, USER).repartition(blocks, "ub")
    named = items.join(singers.select(ITEM, "singer"), ITEM, "left").select(
        ITEM, F.coalesce("singer", F.lit("Unknown")).alias("singer"), vectors.doubles(F.col("factor")).alias("factor")
    )
    # every column is read and no list is dropped, so that both readers share one shuffle of the lists
    whole = F.when(F.xxhash64(USER, "factor") >= F.lit(-(2**63)), F.col("listed"))
    needed = lists.select("ub", F.explode_outer(whole).alias(ITEM)).distinct().join(named, ITEM)
    needed = needed.select("ub", ITEM, "singer", "factor").toDF("_ub", "_item", "singer", "factor").repartition(blocks, "_ub")

    def rank_block(mine: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {USER: [], ITEM: [], "singer": [], "score": []}
        if len(mine) and len(known):
            known = known.sort_values("_item", kind="stable", ignore_index=True)  # rows stand in the order of ties
            place, first = pd.Index(known["_item"].unique()), known["_item"].drop_duplicates().index.to_numpy()
            names, matrix = known["singer"].to_numpy(), np.stack(known["factor"].to_numpy())
            ends = np.append(first[1:], len(known))
            codes, ids = pd.factorize(names)[0], known["_item"].to_numpy()
            for user, listed, factor in zip(mine[USER], mine["listed"], mine["factor"]):
                at = place.get_indexer(listed)
                at = at[at >= 0]
                if len(at) <= least:
                    continue
                at = np.sort(at)
                rows = first[at]
                if len(known) > len(place):  # items under several singers
                    rows = np.concatenate([np.arange(a, b) for a, b in zip(first[at], ends[at])])
                score = np.round(matrix[rows] @ factor, 9)
                order = np.argsort(-score, kind="stable")
                rows, score = rows[order], score[order]
                by = np.argsort(codes[rows], kind="stable")
                starts = np.flatnonzero(np.append(True, np.diff(codes[rows][by]) != 0))
                nth = np.empty(len(by), np.int64)
                nth[by] = np.arange(len(by)) - np.repeat(starts, np.diff(np.append(starts, len(by))))
                best = np.flatnonzero(nth < cap)[:length]
                out[USER] += [user] * len(best)
                out[ITEM] += list(ids[rows[best]])
                out["singer"] += list(names[rows[best]])
                out["score"] += list(score[best])
        return result_frame(out)

    return (
        lists.groupBy("ub").cogroup(needed.groupBy("_ub"))
        .applyInPandas(rank_block, f"{USER} {user_type}, {ITEM} {item_type}, singer string, score double")
    )


def cf_recommend(
    user_factors: DataFrame,
    candidates: DataFrame,
    item_factors: DataFrame,
    good: DataFrame,
    bad: DataFrame,
    excluded: DataFrame,
    singers: DataFrame,
    profiles: DataFrame,
    min_candidates: int = 60,
    length: int = 60,
    extra: int = 100,
    per_singer: int = 3,
    hot_n: int = 50000,
    products=None,
) -> DataFrame:
    """(user_id, item_id, score, rank, tag): final lists by factor product.

    A user with more than ``min_candidates`` usable candidates is ranked over them, others
    over the hot pool. At most ``per_singer`` items per singer, unknown singers counting as
    one. Users with a profile (tag 1) get ``length + extra`` entries, others (tag 0)
    ``length``. products: an accumulator that gets the number of user x hot item products made.
    """
    usable_items = cut_lineage(good_bad_filter(item_factors, good, bad))
    tagged = user_factors.join(
        profiles.select(USER).distinct().withColumn("tag", F.lit(1)), USER, "left"
    ).withColumn("tag", F.coalesce("tag", F.lit(0)))
    longest = length + extra

    by_candidates = cut_lineage(
        _candidate_lists(user_factors, candidates, usable_items, excluded, singers, min_candidates, per_singer, longest)
    )
    poor = user_factors.join(by_candidates.select(USER).distinct(), USER, "left_anti")
    by_hot = _hot_lists(poor, hot_by_norm(usable_items, hot_n), excluded, singers, per_singer, longest, products)
    ranked = capped_top_n(
        by_candidates.unionByName(by_hot), [USER], "singer", [F.desc("score"), F.col(ITEM)], per_singer, longest
    )
    return (
        ranked.join(tagged.select(USER, "tag"), USER)
        .where(F.col("rank") <= F.col("tag") * extra + length)
        .select(USER, ITEM, "score", "rank", "tag")
    )


def vector_resort(lists: DataFrame, user_vectors: DataFrame, item_vectors: DataFrame) -> DataFrame:
    """Re-order each list by user/item cosine; entries without a vector go to the end in list order."""
    scored = (
        lists.join(user_vectors.select(USER, F.col("features").alias("_u")), USER, "left")
        .join(item_vectors.select(ITEM, F.col("features").alias("_v")), ITEM, "left")
        .withColumn("cos", F.round(vectors.cosine(F.col("_u"), F.col("_v")), 9))
    )
    order = [F.desc_nulls_last("cos"), F.col(POS), F.col(ITEM)]
    return numbered(scored, [USER], order, "rank").select(USER, ITEM, "cos", "rank")
