"""The message leg: read keyed messages from the start, split by topic, land every topic twice."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.sinks.tables import TIMESTAMPS
from creditloom.sources.files import path_exists

ENVELOPE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

FILES_PER_BATCH = 100
MESSAGES_PER_BATCH = 10_000_000
# Folders of a zone beside its topics: messages as received, and those that are no row of their topic.
MESSAGES, UNDECODABLE = "_messages", "_undecodable"
CORRUPT = "__corrupt"


def read_bus(
    spark: SparkSession,
    source: str,
    topics: list[str],
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    per_batch: int | None = None,
) -> DataFrame:
    """Streaming (topic, key, value) of the wanted topics, from the earliest message.

    ``per_batch`` bounds a batch (files, or messages of a broker; FILES_PER_BATCH and
    MESSAGES_PER_BATCH by default), so a long backlog is drained in several batches.

    ``fmt="kafka"`` subscribes at the broker ``source`` where the connector is installed; any file
    format reads a folder of envelopes.
    """
    reader = spark.readStream.format(fmt).options(**dict(options or {}))
    if fmt == "kafka":
        reader = reader.option("maxOffsetsPerTrigger", per_batch or MESSAGES_PER_BATCH)
    else:
        reader = reader.option("maxFilesPerTrigger", per_batch or FILES_PER_BATCH)
    if fmt == "kafka":
        raw = (
            reader.option("kafka.bootstrap.servers", source)
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", "earliest")
            .load()
        )
        return raw.select("topic", F.col("key").cast("string"), F.col("value").cast("string"))
    return reader.schema(ENVELOPE).load(source).filter(F.col("topic").isin(*topics))


def decoded(messages: DataFrame, topic: str, schema: T.StructType) -> DataFrame:
    """(topic, key, value, v) of one topic: the text as received and its payload by a fixed schema.

    ``v`` is NULL where the text is absent, is not JSON or has a value of another type.
    """
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("value", kept, {"columnNameOfCorruptRecord": CORRUPT})
    good = F.struct(*[F.col("v")[c].alias(c) for c in schema.names])
    return (
        messages.filter(F.col("topic") == topic)
        .select("topic", "key", "value", parsed.alias("v"))
        .withColumn("v", F.when(F.col("v").isNotNull() & F.col("v")[CORRUPT].isNull(), good))
    )


def land(
    messages: DataFrame,
    zones: list[str],
    checkpoint: str,
    layouts: Mapping[str, tuple[str, T.StructType]],
) -> None:
    """Drain the stream into every zone, then stop.

    ``layouts`` maps a topic to (file format, payload schema). A zone gets the rows of a topic in
    ``<topic>/batch=<id>``, every message unmodified in ``_messages/<topic>/batch=<id>``, and those that
    are no row in ``_undecodable/<topic>/batch=<id>``. A message is parsed once: the first write keeps
    text and payload, all others read it. Progress lives in the checkpoint. A batch that is run again
    after a crash overwrites its own folders, so each message lands once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        for topic, (fmt, schema) in layouts.items():
            place = f"{topic}/batch={batch_id}"
            parsed = decoded(batch, topic, schema)
            first = f"{zones[0]}/{MESSAGES}/{place}"
            parsed.write.mode("overwrite").parquet(first)
            seen = batch.sparkSession.read.schema(parsed.schema).parquet(first)
            for zone in zones:
                if zone != zones[0]:
                    seen.write.mode("overwrite").parquet(f"{zone}/{MESSAGES}/{place}")
                out = seen.filter(F.col("v").isNotNull()).select("v.*").write.mode("overwrite")
                out = out.options(**TIMESTAMPS)
                if fmt == "csv":
                    out = out.option("header", True)
                out.format(fmt).save(f"{zone}/{place}")
                bad = seen.filter(F.col("v").isNull()).select("topic", "key", "value")
                bad.write.mode("overwrite").parquet(f"{zone}/{UNDECODABLE}/{place}")

    query = (
        messages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def received(spark: SparkSession, zone: str, topic: str, folder: str = MESSAGES) -> DataFrame:
    """Messages of a topic as received (or, by ``folder``, those of them that are no row)."""
    path = f"{zone}/{folder}/{topic}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], ENVELOPE)
    return spark.read.schema(ENVELOPE).parquet(f"{path}/*")


def landed(spark: SparkSession, zone: str, topic: str, fmt: str, schema: T.StructType) -> DataFrame:
    """Batch view of everything a zone holds of a topic; nothing landed yet reads as no rows."""
    if not path_exists(spark, f"{zone}/{topic}"):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(f"{zone}/{topic}/*").select(*schema.names)


def batch_record(spark: SparkSession, zones: list[str], layouts: Mapping[str, tuple[str, T.StructType]]) -> DataFrame:
    """(topic, batch, received, rows, undecodable, zones): messages of each batch next to what landed of them.

    Counted from the zones, so it holds for every run so far; ``zones`` counts the zones that have all of them.
    """
    parts = []
    for zone in zones:
        for topic, (fmt, _) in layouts.items():
            for kind, path, form in (
                ("received", f"{zone}/{MESSAGES}/{topic}", "parquet"),
                ("rows", f"{zone}/{topic}", fmt),
                ("undecodable", f"{zone}/{UNDECODABLE}/{topic}", "parquet"),
            ):
                if not path_exists(spark, path):
                    continue
                reader = spark.read.option("header", form == "csv").format(form)
                # the columns don't matter to a count; a text file's are those of any one line
                schema = ENVELOPE if kind != "rows" else layouts[topic][1]
                rows = reader.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).load(path)
                counted = rows.groupBy("batch").agg(F.count("*").alias("n"))
                parts.append(counted.select(F.lit(zone).alias("zone"), F.lit(topic).alias("topic"), "batch", F.lit(kind).alias("kind"), "n"))
    if not parts:
        return spark.createDataFrame([], "topic string, batch bigint, received bigint, rows bigint, undecodable bigint, zones bigint")
    per_zone = reduce(DataFrame.unionByName, parts).groupBy("topic", "batch", "zone").agg(
        *[F.coalesce(F.max(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(k) for k in ("received", "rows", "undecodable")]
    )
    complete = F.col("received") == F.col("rows") + F.col("undecodable")
    return per_zone.groupBy("topic", "batch").agg(
        F.max("received").alias("received"), F.max("rows").alias("rows"), F.max("undecodable").alias("undecodable"),
        F.count_if(complete).alias("zones"),
    )


def topic_counts(messages: DataFrame, sink: str, checkpoint: str) -> DataFrame:
    """Running message count per topic; the last complete state is returned as a batch table."""
    spark = messages.sparkSession

    def write(state: DataFrame, batch_id: int) -> None:
        state.write.mode("overwrite").parquet(sink)

    query = (
        messages.groupBy("topic")
        .agg(F.count("*").alias("messages"))
        .writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema("topic string, messages bigint").parquet(sink)
