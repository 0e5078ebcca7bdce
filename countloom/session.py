"""Session defaults and the one place that decides where checkpoints go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "countloom", cores: str = "*", memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; fall back only when none is set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        context.setCheckpointDir(named)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def reuse(df: DataFrame) -> DataFrame:
    """Write a reduced table that several later passes read, and cut its lineage.

    Used for per-gene, per-sample and per-cell tables only, never for raw counts.
    It runs the job at once; the files live in the shared checkpoint folder, so a
    lost executor costs a re-read, not a recomputation.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def spread(df: DataFrame, rows: int = 10_000) -> DataFrame:
    """The same rows over as many tasks as hold about ``rows`` of them each.

    For reviewed tables: their files are small, but each row becomes many, and what
    was read in few tasks would stay in few.
    """
    return df.repartition(df.count() // rows + 1)


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows as a written table, with the size of its files for an estimate.

    For loops: turns over checkpoints became slower and slower, as if the estimates
    of the plans behind them multiplied; over written tables they stay alike.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex[:12]}"
