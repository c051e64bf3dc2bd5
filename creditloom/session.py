"""Session helpers: a local session for tests and bench, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "creditloom") -> SparkSession:
    """Session for tests and the bench; a cluster job brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of its own machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="creditloom-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never handed out twice."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/creditloom/{app}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Cut the lineage of ``df`` by writing it to the shared folder and reading it back.

    The written table survives lost executors, and every later reader sees the same rows even
    where ``df`` itself would come out in another order when recomputed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete all that this application has written below the shared folder, at the end of a job.

    Frames that read from it are of no use afterwards.
    """
    from creditloom.sources.files import delete_path

    delete_path(spark, f"{shared_root(spark)}/creditloom/{spark.sparkContext.applicationId}")
