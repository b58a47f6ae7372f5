"""Session defaults and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: str = "*", app: str = "tunecrate", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benches. A cluster brings its own configuration."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Directory for reliable checkpoints.

    The session's ``spark.checkpoint.dir`` wins. A temporary folder is used only
    under a local master; on a cluster an unset directory is an error, because
    executors could not share a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        path = tempfile.mkdtemp(prefix="tunecrate-ckpt-")
    sc.setCheckpointDir(path)
    return path


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries planned inside remove their shuffle files once they end; files a lost executor takes along are written anew."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from the files.

    Later stages read the files, so a lost executor costs a re-read, not a replay. The step's
    shuffle files go once it is written.
    """
    ensure_checkpoint_dir(df.sparkSession)
    step = df.select("*")  # planned anew, so that the shuffles are its own
    kept = step.checkpoint(eager=True)
    plan, cleaner = step._jdf.queryExecution().executedPlan(), df.sparkSession.sparkContext._jsc.sc().cleaner()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" and cleaner.isDefined():  # checkpoints do not heed DROP_SHUFFLES
        for shuffle in list(plan.context().shuffleIds().keySet()):
            cleaner.get().doCleanupShuffle(shuffle, True)
    return kept


def written(df: DataFrame, name: str) -> DataFrame:
    """Like :func:`cut_lineage`, in Parquet files: for large tables that are read several times, by columns.

    The files stay until the folder is cleared.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with _shuffles_dropped(df.sparkSession):
        df.select("*").write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
