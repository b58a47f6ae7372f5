"""Written intermediate tables and size-checked joins."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunecrate.session import ensure_checkpoint_dir

#: Rows of (key, short payload) that may be broadcast: some tens of MB.
BROADCAST_ROWS = 500_000


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Python workers get ``rows`` rows at a time in what runs inside; texts are long, and default batches hold 10,000."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage ends at the files."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (already written) with a broadcast hint if it has at most ``rows`` rows, else as it is."""
    return F.broadcast(df) if df.count() <= rows else df


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text, _h): one key per row content. Equal ids with other texts stay apart; null text is empty."""
    filled = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), filled.alias("text"), F.xxhash64(filled).alias("_h"))


def same_key(left: DataFrame, right: DataFrame, columns: Sequence[str] = ("doc_id", "_h")):
    """Join condition on keys in which null equals null."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & left[c].eqNullSafe(right[c])
    return condition
