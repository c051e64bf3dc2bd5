"""Keyed state over a stream: rows that land once, the newest row per key, payloads of any shape.

Every function drains what the bus holds and stops; progress and state live in the checkpoint, so the next run goes
on where the last one ended. A batch that runs again after a crash overwrites its own folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.operators.windows import latest
from creditloom.sources.files import path_exists
from creditloom.streaming.bus import decoded


def _drain(rows: DataFrame, folder: str, checkpoint: str, mode: str) -> list:
    """Write each batch to its folder; returns the progress of the batches."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    query = (
        rows.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query.recentProgress


def batches(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All that a drain has written, with the column ``batch``; nothing yet reads as no rows."""
    full = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    if not path_exists(spark, folder):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(folder)


def land_once(
    messages: DataFrame,
    topic: str,
    schema: T.StructType,
    key: list[str],
    time: str,
    delay: str,
    folder: str,
    checkpoint: str,
) -> int:
    """Land the rows of a topic, each key once; returns how many rows came too late to be told apart.

    A key is remembered until the event time has moved on by ``delay``, so the state is that of one
    delay, however long the stream is. A row older than that isn't landed, since its key may have
    been forgotten; it is counted instead. Texts that are no row of the topic are left to ``bus.land``.
    """
    rows = decoded(messages, topic, schema).filter(F.col("v").isNotNull()).select("v.*")
    # the event time has to be a timestamp with a zone, the landed column keeps its type
    timed = rows.withColumn("__at", F.col(time).cast("timestamp")).withWatermark("__at", delay)
    progress = _drain(timed.dropDuplicatesWithinWatermark(key).drop("__at"), folder, checkpoint, "append")
    return sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"])


def land_latest(rows: DataFrame, keys: list[str], order: list[str], folder: str, checkpoint: str) -> None:
    """Keep the newest row per key while rows arrive in any order: one row of state per key.

    A batch writes the keys that it changed; ``newest`` reads the table.
    """
    others = [c for c in rows.columns if c not in keys]
    newest_row = F.max_by(F.struct(*others), F.struct(*order)).alias("row")
    _drain(rows.groupBy(*keys).agg(newest_row).select(*keys, "row.*"), folder, checkpoint, "update")


def newest(spark: SparkSession, folder: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """The newest row per key that ``land_latest`` has written, in any number of runs."""
    return latest(batches(spark, folder, schema), keys, ["batch"]).drop("batch")


VARIANTS = T.StructType([T.StructField("key", T.StringType()), T.StructField("v", T.VariantType())])


def land_any(messages: DataFrame, topic: str, folder: str, checkpoint: str) -> None:
    """Land payloads of unknown shape: ``key`` and the payload ``v`` as a variant, NULL where it isn't JSON.

    Fields that no schema knows yet are kept and can be asked for with ``variant_get``.
    """
    rows = messages.filter(F.col("topic") == topic).select("key", F.try_parse_json("value").alias("v"))
    _drain(rows, folder, checkpoint, "append")


def shape_of(payloads: DataFrame) -> str:
    """The schema that all payloads so far fit, as DDL; new fields show up here first."""
    return payloads.agg(F.schema_of_variant_agg("v").alias("shape")).first()["shape"]
