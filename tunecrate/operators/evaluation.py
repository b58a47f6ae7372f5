"""Ranking quality: AUC, ROC curve, hit rate. (score, label) frames with label 0 / 1."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunecrate.operators.ranking_windows import running_total

RANGES = 256


def auc(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One row (positives, negatives, auc): exact area under the ROC curve, ties counted half.

    Equal scores collapse map-side to (positives, negatives). The running count of lower
    negatives is taken per score range, so no task sorts all scores. Null if a class is empty.
    """
    positive = F.when(F.col(label) > 0.5, 1).otherwise(0)
    per_score = scored.groupBy(F.col(score).alias("s")).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg")
    )
    bounds = per_score.agg(
        F.percentile_approx("s", [i / RANGES for i in range(1, RANGES)], 10000).alias("b")
    )
    ranged = per_score.withColumn("_bounds", bounds.scalar()).withColumn(
        "_range", F.size(F.filter("_bounds", lambda x: x < F.col("s")))
    ).drop("_bounds")
    below = running_total(ranged, [], "_range", [F.col("s")], F.col("neg"), "neg_up_to")
    wins = F.sum(F.col("pos") * (F.col("neg_up_to") - F.col("neg") + F.col("neg") / 2))
    return below.agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), wins.alias("_w")).select(
        "positives", "negatives", F.try_divide("_w", F.col("positives") * F.col("negatives")).alias("auc")
    )


def roc_curve(scored: DataFrame, score: str = "score", label: str = "label", bins: int = 100) -> DataFrame:
    """(bin, fpr, tpr) from high to low score; scores in [0, 1] fall into equal-width bins, others into the first or last."""
    positive = F.when(F.col(label) > 0.5, 1).otherwise(0)
    level = F.greatest(F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)), F.lit(0)).cast("int")
    binned = scored.groupBy(level.alias("bin")).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg")
    )
    total = binned.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    descending = binned.withColumn("_step", F.lit(bins - 1) - F.col("bin"))
    summed = running_total(descending.withColumn("_b", F.lit(0)), [], "_b", [F.col("_step")], F.col("pos"), "tp")
    summed = running_total(summed, [], "_b", [F.col("_step")], F.col("neg"), "fp")
    return summed.select(
        "bin",
        (F.col("fp") / total.select("n").scalar()).alias("fpr"),
        (F.col("tp") / total.select("p").scalar()).alias("tpr"),
    )


def hit_at_1(scored: DataFrame, user: str = "user_id", score: str = "pred", label: str = "label") -> DataFrame:
    """One row (users, hits, ratio): users with a second-best row, share whose best row is positive.

    Both ranks come from aggregates that combine map-side: the number of rows and the best row.
    Ties at the top average to ranks 1.5, which are neither first nor second, and do not count.
    """
    by_score = scored.groupBy(user, score).agg(F.count("*").alias("n"), F.max(label).alias("label"))
    best = by_score.groupBy(user).agg(
        F.max(F.struct(score, "n", "label")).alias("top"), F.count("*").alias("levels")
    )
    runner_up = by_score.join(best.select(user, F.col("top")[score].alias("_t")), user).where(
        F.col(score) < F.col("_t")
    ).groupBy(user).agg(F.max(F.struct(score, "n")).alias("second"))
    joined = best.join(runner_up, user, "left")
    first_alone = F.col("top.n") == 1
    return joined.agg(
        F.sum(F.when(first_alone & (F.col("second.n") == 1), 1).otherwise(0)).alias("users"),
        F.sum(F.when(first_alone & (F.col("top.label") > 0.5), 1).otherwise(0)).alias("hits"),
    ).withColumn("ratio", F.try_divide("hits", "users"))
