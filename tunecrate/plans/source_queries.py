"""Text contracts as round trips: lines are built from the test tables and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunecrate.functions import measures
from tunecrate.operators import filters, lists
from tunecrate.operators.ranking_windows import numbered
from tunecrate.plans.recall_queries import _draw_int
from tunecrate.plans.registry import query
from tunecrate.plans.views import View, with_views
from tunecrate.sources import readers, sinks


def _value(*parts) -> Column:
    return F.concat(*parts).alias("value")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


@query(
    "source_triples",
    "SELECT CAST(l_orderkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS item_id, l_quantity AS dur FROM lineitem "
    "WHERE l_linenumber NOT IN (5, 6, 7)",
)
def source_triples(v: View) -> DataFrame:
    """Lines of wrong arity (6), a wrong delimiter (7) or without a number (5) are dropped."""
    number = F.when(F.col("l_linenumber") == 5, "n/a").otherwise(_text("l_quantity"))
    line = F.concat_ws("|", _text("l_orderkey"), _text("l_partkey"), number)
    line = F.when(F.col("l_linenumber") == 6, F.concat(line, F.lit("|extra"))).when(F.col("l_linenumber") == 7, F.translate(line, "|", ";"))
    whole = F.concat_ws("|", _text("l_orderkey"), _text("l_partkey"), number)
    return readers.triples(v.spark, v.table("lineitem").select(F.coalesce(line, whole).alias("value")))


@query(
    "source_user_lists",
    with_views(["recs"], "SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(item_id AS VARCHAR) AS item_id, "
    "ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY item_id) AS pos FROM recs"),
)
def source_user_lists(v: View) -> DataFrame:
    """Lists written as ``user=i1,i2`` come back in long form, positions and all."""
    placed = numbered(v.recs, ["user_id"], [F.col("item_id")], "pos")
    packed = lists.format_list(placed).select(_value(_text("user_id"), F.lit("="), F.col("items")))
    broken = packed.select(F.concat("value", F.lit("=again")).alias("value"))
    return lists.explode_list(readers.user_lists(v.spark, packed.unionByName(broken)))


def _rendered(sep: str) -> Column:
    return F.array_join(F.transform(F.slice("features", 1, 8), lambda x: F.format_string("%.5f", x)), sep)


_FEATURES = "list_transform(features[1:8], lambda x: CAST(printf('%.5f', x) AS DOUBLE))"


@query(
    "source_vectors",
    with_views(["vec"], "SELECT form, CAST(id AS VARCHAR) AS id, CASE WHEN form = 'c' THEN 2.5::DOUBLE END AS norm, "
    f"{_FEATURES} AS features FROM vec, (SELECT UNNEST(['a', 'b', 'c']) AS form)"),
)
def source_vectors(v: View) -> DataFrame:
    """The three vector forms; a vector with a word in it is dropped."""
    key = _text("id")
    a = v.vec.select(_value(key, F.lit("|"), _rendered("=")))
    b = v.vec.select(_value(key, F.lit("="), _rendered("|")))
    c = v.vec.select(_value(key, F.lit("=2.5="), _rendered("|")))
    bad = v.vec.select(_value(key, F.lit("|0.5=none")))
    none = F.lit(None).cast("double").alias("norm")
    form = lambda name, df: df.select(F.lit(name).alias("form"), "id", "norm" if "norm" in df.columns else none, "features")
    return (
        form("a", readers.feature_vectors(v.spark, a.unionByName(bad)))
        .unionByName(form("b", readers.feature_vectors(v.spark, b, "=", "|")))
        .unionByName(form("c", readers.feature_vectors(v.spark, c, "=", "|", norm=True)))
    )


@query("source_ids", "SELECT p_brand AS item_id FROM part WHERE p_size % 5 <> 0")
def source_ids(v: View) -> DataFrame:
    """One id per line with spaces around it; blank lines are skipped."""
    padded = F.concat(F.lit("  "), F.col("p_brand"), F.lit(" "))
    return readers.id_list(v.spark, v.table("part").select(F.when(F.col("p_size") % 5 == 0, "   ").otherwise(padded).alias("value")))


@query(
    "source_sentences",
    with_views(["playlist_item"], "SELECT CAST(playlist_id AS VARCHAR) AS key, list(CAST(item_id AS VARCHAR) ORDER BY item_id) AS seq "
    "FROM playlist_item GROUP BY 1"),
)
def source_sentences(v: View) -> DataFrame:
    placed = numbered(v.playlist_item.withColumnRenamed("playlist_id", "user_id"), ["user_id"], [F.col("item_id")], "pos")
    packed = lists.format_list(placed)
    return readers.sentences(v.spark, packed.select(_value(_text("user_id"), F.lit("!"), F.col("items"))))


@query(
    "source_libsvm",
    "SELECT CAST(p_size % 2 AS DOUBLE) AS label, [CAST(p_partkey AS DOUBLE), 0.0, CAST(p_size AS DOUBLE), 0.0] AS features FROM part",
)
def source_libsvm(v: View) -> DataFrame:
    part = v.table("part")
    line = F.concat_ws(" ", (F.col("p_size") % 2).cast("string"), F.concat(F.lit("1:"), _text("p_partkey")), F.concat(F.lit("3:"), _text("p_size")))
    return readers.libsvm(v.spark, part.select(line.alias("value")).unionByName(part.limit(1).select(F.lit("no label").alias("value"))), 4)


@query("sink_lines", with_views(["plays"], "SELECT user_id || '|' || item_id || '|' || printf('%.3f', dur) AS value FROM plays"))
def sink_lines(v: View) -> DataFrame:
    return sinks.lines(v.plays.withColumn("dur", F.format_string("%.3f", "dur")), "|", "user_id", "item_id", "dur")


@query("clamp_duration", with_views(["plays"], "SELECT user_id, item_id, LEAST(dur, 3.0) AS dur FROM plays"))
def clamp_duration(v: View) -> DataFrame:
    return v.plays.select("user_id", "item_id", measures.clamp(F.col("dur"), 3.0).alias("dur"))


@query(
    "train_test_split",
    with_views(["plays"], f"SELECT user_id, item_id, {_draw_int(7, 'user_id', 'item_id')} < {int(0.8 * 2**32)} AS train FROM plays"),
)
def train_test_split(v: View) -> DataFrame:
    train, test = filters.split_by_key(v.plays, 0.8, 7, "user_id", "item_id")
    return train.select("user_id", "item_id", F.lit(True).alias("train")).unionByName(test.select("user_id", "item_id", F.lit(False).alias("train")))
