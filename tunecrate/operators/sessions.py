"""Focus sessions and time-interval overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunecrate.functions import measures


def focus_sessions(timeline: DataFrame, gap: float, user: str = "user_id", ts: str = "ts") -> DataFrame:
    """(user, session_start, session_end, seconds, events): split where the gap is at least ``gap`` seconds.

    Events of one user in the same slot of ``gap`` seconds are closer than the gap, so they
    belong together: a map-side combined aggregation per (user, slot) replaces a window over
    events. Slots are then stitched per user; their number is bounded by the time span, not
    by the events. A single event is a session of length 0.
    """
    micros = int(round(gap * 1e6))
    slots = (
        timeline.select(user, measures.epoch_micros(timeline, ts).alias("t"))
        .groupBy(user, (F.col("t") - F.pmod("t", F.lit(micros))).alias("slot"))
        .agg(F.min("t").alias("s"), F.max("t").alias("e"), F.count("*").alias("events"))
    )
    order = Window.partitionBy(user).orderBy("s")
    stitched = (
        slots.withColumn("_prev", F.lag("e").over(order))
        .withColumn("_new", F.when(F.col("_prev").isNull() | (F.col("s") - F.col("_prev") >= micros), 1).otherwise(0))
        .withColumn("_session", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(user, "_session")
        .agg(F.min("s").alias("s"), F.max("e").alias("e"), F.sum("events").alias("events"))
    )
    return stitched.select(
        user,
        (F.col("s") / 1e6).alias("session_start"),
        (F.col("e") / 1e6).alias("session_end"),
        ((F.col("e") - F.col("s")) / 1e6).alias("seconds"),
        "events",
    )


def interval_overlap(
    foreground: DataFrame, listening: DataFrame, user: str = "user_id", by: str = "module", slot_seconds: int = 3600
) -> DataFrame:
    """(module, seconds, users): listening time that falls into app-foreground time.

    foreground: (user, start, end); listening: (user, start, end, module), in seconds.
    Both sides are cut at slot borders and joined on (user, slot); the overlaps of the
    cut pieces add up to the overlap of the intervals, and a busy user spreads over slots.
    Equal pieces are merged with a multiplicity first, so repeats do not pair up.
    """

    def pieces(df: DataFrame, tag: str, *keep: str) -> DataFrame:
        slot = F.explode(
            F.sequence(
                F.floor(F.col("start") / slot_seconds).cast("bigint"),
                F.floor(F.col("end") / slot_seconds).cast("bigint"),
            )
        )
        cut = (
            df.where(F.col("end") >= F.col("start"))
            .withColumn("slot", slot)
            .select(
                user, "slot", *keep,
                F.greatest(F.col("start"), F.col("slot") * F.lit(slot_seconds)).alias(f"{tag}_s"),
                F.least(F.col("end"), (F.col("slot") + 1) * F.lit(slot_seconds)).alias(f"{tag}_e"),
            )
        )
        return cut.groupBy(user, "slot", *keep, f"{tag}_s", f"{tag}_e").agg(F.count("*").alias(f"{tag}_n"))

    pairs = pieces(foreground, "f").join(pieces(listening, "l", by), [user, "slot"]).where(
        (F.col("f_s") <= F.col("l_e")) & (F.col("l_s") <= F.col("f_e"))
    )
    overlap = (F.least("f_e", "l_e") - F.greatest("f_s", "l_s")) * F.col("f_n") * F.col("l_n")
    per_user = pairs.groupBy(by, user).agg(F.sum(overlap).alias("seconds"))
    return per_user.groupBy(by).agg(
        F.sum("seconds").alias("seconds"), F.count("*").alias("users")
    )
