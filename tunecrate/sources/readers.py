"""Readers for the delimited text contracts. Rows of the wrong shape are dropped, not raised.

A reader takes a path, or lines as a frame with a column ``value``.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


Source = str | DataFrame


def _lines(spark: SparkSession, source: Source) -> DataFrame:
    return spark.read.text(source) if isinstance(source, str) else source


def _fields(spark: SparkSession, source: Source, sep: str, arity: int) -> DataFrame:
    """Lines with exactly ``arity`` fields as array ``f``."""
    lines = _lines(spark, source)
    parts = F.split("value", "\\Q" + sep + "\\E", -1)
    return lines.select(parts.alias("f")).where(F.size("f") == arity)


def triples(
    spark: SparkSession, source: Source, names: tuple[str, str, str] = ("user_id", "item_id", "dur"),
    kind: str = "double", sep: str = "|",
) -> DataFrame:
    """``k1|k2|number``; lines without a number are dropped."""
    a, b, n = names
    return _fields(spark, source, sep, 3).select(
        F.col("f")[0].alias(a), F.col("f")[1].alias(b), F.col("f")[2].try_cast(kind).alias(n)
    ).where(F.col(n).isNotNull())


def pairs(spark: SparkSession, source: Source, names: tuple[str, str], sep: str = "|") -> DataFrame:
    """``a|b`` (id pairs, item|singer, album|tag); other arities are dropped."""
    return _fields(spark, source, sep, 2).select(F.col("f")[0].alias(names[0]), F.col("f")[1].alias(names[1]))


def scalar_dictionary(spark: SparkSession, source: Source, names: tuple[str, str] = ("item_id", "idf"), sep: str = "|") -> DataFrame:
    """``item|number``."""
    out = pairs(spark, source, names, sep).withColumn(names[1], F.col(names[1]).try_cast("double"))
    return out.where(F.col(names[1]).isNotNull())


def pool(spark: SparkSession, source: Source, sep: str = "|") -> DataFrame:
    """``src|dst|sim|rank``."""
    return _fields(spark, source, sep, 4).select(
        F.col("f")[0].alias("src"), F.col("f")[1].alias("dst"),
        F.col("f")[2].try_cast("double").alias("sim"), F.col("f")[3].try_cast("int").alias("rank"),
    ).where(F.col("sim").isNotNull() & F.col("rank").isNotNull())


def user_lists(spark: SparkSession, source: Source, sep: str = "=") -> DataFrame:
    """``user=i1,i2,…`` as (user_id, items array)."""
    return _fields(spark, source, sep, 2).select(
        F.col("f")[0].alias("user_id"), F.split(F.col("f")[1], ",").alias("items")
    )


def _number_array(text: Column, sep: str) -> Column:
    return F.transform(F.split(text, "\\Q" + sep + "\\E"), lambda x: x.try_cast("double"))


def feature_vectors(spark: SparkSession, source: Source, outer: str = "|", inner: str = "=", norm: bool = False) -> DataFrame:
    """``id|f=f`` (outer ``|``, inner ``=``), ``id=f|f`` (reversed) or ``id=norm=f|f`` (``norm``)."""
    rows = _fields(spark, source, outer, 3 if norm else 2)
    extra = [F.col("f")[1].try_cast("double").alias("norm")] if norm else []
    vec = _number_array(F.col("f")[2 if norm else 1], inner).alias("features")
    out = rows.select(F.col("f")[0].alias("id"), *extra, vec)
    return out.where(F.forall("features", lambda x: x.isNotNull()))


def labelled_samples(spark: SparkSession, source: Source, outer: str = "|", inner: str = "=") -> DataFrame:
    """``label|f=f`` or ``label=f|f`` as (label, features)."""
    rows = feature_vectors(spark, source, outer, inner)
    return rows.select(F.col("id").try_cast("double").alias("label"), "features").where(F.col("label").isNotNull())


def click_samples(spark: SparkSession, source: Source, sep: str = "|") -> DataFrame:
    """``session|playlist|clicked list|shown|features…`` as (session, playlist, clicked, shown, features)."""
    parts = F.split("value", "\\Q" + sep + "\\E", -1)
    rows = _lines(spark, source).select(parts.alias("f")).where(F.size("f") > 4)
    numbers = F.transform(F.slice("f", 5, F.size("f") - 4), lambda x: x.try_cast("double"))
    return rows.select(
        F.col("f")[0].alias("session"), F.col("f")[1].alias("playlist"),
        F.split(F.col("f")[2], ",").alias("clicked"), F.col("f")[3].alias("shown"), numbers.alias("features"),
    ).where(F.forall("features", lambda x: x.isNotNull()))


def id_list(spark: SparkSession, source: Source, name: str = "item_id") -> DataFrame:
    """One id per line; blank lines are skipped."""
    return _lines(spark, source).select(F.trim("value").alias(name)).where(F.length(name) > 0)


def timelines(spark: SparkSession, source: Source) -> DataFrame:
    """``user|t1,t2,…`` (epoch seconds) in long form (user_id, ts)."""
    rows = _fields(spark, source, "|", 2).select(
        F.col("f")[0].alias("user_id"), F.explode(F.split(F.col("f")[1], ",")).alias("t")
    )
    seconds = F.col("t").try_cast("double")
    return rows.where(seconds.isNotNull()).select("user_id", F.timestamp_seconds(seconds).alias("ts"))


def sentences(spark: SparkSession, source: Source) -> DataFrame:
    """``key!i1,i2,…`` as (key, seq array)."""
    return _fields(spark, source, "!", 2).select(
        F.col("f")[0].alias("key"), F.split(F.col("f")[1], ",").alias("seq")
    )


def playlist_texts(spark: SparkSession, source: Source, block_sep: str = "@BI_ROW_SPLIT@") -> DataFrame:
    """``id|name|intro|blocks`` as (doc_id, name, blocks); the third field is the text name."""
    return _fields(spark, source, "|", 4).select(
        F.col("f")[0].alias("doc_id"), F.col("f")[2].alias("name"),
        F.split(F.col("f")[3], "\\Q" + block_sep + "\\E").alias("blocks"),
    )


def edges(spark: SparkSession, source: Source) -> DataFrame:
    """``from|to|weight`` with every edge walked in both directions."""
    one = triples(spark, source, ("src", "dst", "w"))
    other = one.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")
    return one.unionByName(other).groupBy("src", "dst").agg(F.max("w").alias("w"))


def libsvm(spark: SparkSession, source: Source, width: int) -> DataFrame:
    """LibSVM lines ``label index:value …`` (indices from 1) as (label, features array); the given width avoids a scan for it."""
    if isinstance(source, str):
        raw = spark.read.format("libsvm").option("numFeatures", str(width)).load(source)
        return raw.select("label", vector_to_array("features").alias("features"))
    parts = source.select(F.split(F.trim("value"), r"\s+").alias("f")).where(F.col("f")[0].try_cast("double").isNotNull())
    entry = lambda x: F.struct(F.split_part(x, F.lit(":"), F.lit(1)).try_cast("int"), F.split_part(x, F.lit(":"), F.lit(2)).try_cast("double"))
    entries = F.map_from_entries(F.transform(F.slice("f", F.lit(2), F.size("f") - 1), entry))
    dense = F.transform(F.sequence(F.lit(1), F.lit(width)), lambda i: F.coalesce(F.element_at("_m", i), F.lit(0.0)))
    return parts.select(F.col("f")[0].try_cast("double").alias("label"), entries.alias("_m")).select("label", dense.alias("features"))


def table_days(spark: SparkSession, table: str, first_day: str, last_day: str | None = None, day: str = "dt") -> DataFrame:
    """Day partitions of a catalog table; the predicate prunes partitions."""
    df = spark.table(table)
    return df.where(F.col(day) == first_day) if last_day is None else df.where(F.col(day).between(first_day, last_day))


def last_days(spark: SparkSession, table: str, until: str, days: int, day: str = "dt") -> DataFrame:
    """The last ``days`` day partitions up to and including ``until`` (``yyyy-MM-dd``)."""
    first = date.fromisoformat(until) - timedelta(days=days - 1)
    return table_days(spark, table, first.isoformat(), until, day)
