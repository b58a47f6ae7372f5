"""Spelling variants of the corpus vocabulary by permuterm rotations.

A word is marked with a terminator and rotated; written as ``x c y`` around its character
``c``, its rotation is ``y END x c``. Rotations are sorted (range-partitioned by all but the
edited character), and in that order words that differ at one place are neighbours:

* replacement: ``y END x`` is the rotation of both words without its last character;
* insertion, deletion: the shorter word's whole rotation ``y END x`` is the longer word's
  rotation without its last character.

One scan of the sorted rotations with window functions counts each word's partners and keeps
the best one; pairs are never listed. A group has one row per character that fits its gap and
at most one whole word, so its size is bounded by the alphabet. In a run of equal characters
only the first is taken out for deletions, so each pair of words meets in exactly one group.

Defined cases: null text has no words; a null id is the empty text in the hash that picks
deletions; repeated rows count again; extra columns are ignored; an empty table has no words.
Equal counts are told apart by code-point order.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunecrate.llm.storage import stored

RUN = "[a-zÀ-ÿ]+"  # after A-Z are lower-cased
TERMINATOR = "\u0000"
DELETE_EVERY = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5


def vocabulary(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, delete_every: int = DELETE_EVERY,
) -> DataFrame:
    """(word, n): words with at least that many code points and occurrences, counted over whole texts.

    Where ``delete_every`` divides the CRC-32 of ``<doc_id>:<word>``, the word loses one code
    point, which plants typing errors; 0 plants none. Counting combines map-side, so a frequent
    word ships one row per task.
    """
    lowered = F.translate(F.col(text), ascii_uppercase, ascii_lowercase)
    runs = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_id"), F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("_run")
    ).where(F.length("_run") >= least_length)
    word = F.col("_run")
    if delete_every:
        runs = runs.withColumn("_crc", F.crc32(F.concat("_id", F.lit(":"), "_run")))
        at = (F.col("_crc") % F.length("_run")).cast("int")
        short = F.concat(word.substr(F.lit(1), at), word.substr(at + 2, F.length(word)))
        word = F.when(F.col("_crc") % delete_every == 0, short).otherwise(word)
    counted = runs.select(word.alias("word")).where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, word, n, whole, first): every rotation of each word, and every one without the character it ends with.

    ``whole``: nothing is taken out; ``first``: the character taken out does not follow its equal.
    """
    word, size = F.col("word"), F.length("word")

    def turned(start: Column, end: Column) -> Column:
        return F.concat(word.substr(start + 1, size), F.lit(TERMINATOR), word.substr(F.lit(1), end))

    def without(i: Column) -> Column:
        here, before = word.substr(i + 1, F.lit(1)), word.substr(i, F.lit(1))
        return F.struct(turned(i + 1, i).alias("prefix"), F.lit(False).alias("whole"), ((i == 0) | (here != before)).alias("first"))

    def whole(i: Column) -> Column:
        return F.struct(turned(i, i).alias("prefix"), F.lit(True).alias("whole"), F.lit(False).alias("first"))

    rows = F.concat(F.transform(F.sequence(F.lit(0), size - 1), without), F.transform(F.sequence(F.lit(0), size), whole))
    return words.select("word", "n", F.inline(rows))


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best): the number of near words, and the one of largest ``n`` as (m, word) with m = -n."""
    ranked = rotations(words).repartitionByRange("prefix")
    group = Window.partitionBy("prefix")
    order = group.orderBy("whole", F.desc("n"), "word")
    entry = F.struct((-F.col("n")).alias("m"), "word")
    edited = ~F.col("whole")
    scanned = ranked.select(
        "word", "whole", "first",
        F.sum(edited.cast("bigint")).over(group).alias("n_edited"),
        F.sum(F.col("first").cast("bigint")).over(group).alias("n_first"),
        F.sum(F.col("whole").cast("bigint")).over(group).alias("n_whole"),
        F.first(entry).over(order).alias("top"),
        F.lead(F.when(edited, entry)).over(order).alias("next"),
        F.row_number().over(order).alias("at"),
        F.min(F.when(F.col("whole"), entry)).over(group).alias("shorter"),
        F.min(F.when(F.col("first"), entry)).over(group).alias("longer"),
    )
    other = F.when(F.col("at") == 1, F.col("next")).otherwise(F.col("top"))
    indel = F.when(F.col("first"), F.col("n_whole")).otherwise(0)
    met = scanned.select(
        "word",
        F.when(F.col("whole"), F.col("n_first")).otherwise(F.col("n_edited") - 1 + indel).alias("met"),
        F.when(F.col("whole"), F.col("longer")).otherwise(F.least(other, F.when(F.col("first"), F.col("shorter")))).alias("best"),
    )
    return met.where(F.col("met") > 0).groupBy("word").agg(F.sum("met").alias("n_near"), F.min("best").alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) of words with a form: each round doubles the part of the chain that is behind.

    A form has ``RATIO`` times its word's count, so chains are short and have no cycle.
    """
    state = stored(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = state.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        joined = stored(state.join(step, "root", "left").select("word", F.coalesce("_further", "root").alias("root"), "_further"), "spelling-roots")
        state = joined.drop("_further")
        if not joined.where(F.col("_further").isNotNull()).limit(1).count():
            return state


def spelling_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for a vocabulary (word, n) of distinct words.

    form: the near word of largest ``n`` where that is at least ``ratio`` times the word's own,
    else null; root: the end of the chain of forms. ``ratio`` must be 2 or more.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more: chains of forms could be cycles")
    words = stored(words.select("word", F.col("n").cast("bigint").alias("n")), "spelling-words")
    best_n = -F.col("best.m")
    strong = best_n >= ratio * F.col("n")
    table = stored(
        words.join(neighbours(words), "word", "left").select(
            "word", F.when(strong, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(strong, best_n).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(table.where(F.col("form").isNotNull()))
    return table.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def document_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Spelling groups of the vocabulary of ``docs``."""
    return spelling_groups(vocabulary(docs, doc_id, text))
