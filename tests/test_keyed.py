"""Keyed state over streams, batch by batch and over restarts; bucketed tables without a shuffle by key."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.operators.joins import orphan_rows
from creditloom.operators.windows import latest
from creditloom.sinks import tables
from creditloom.streaming import bus, keyed

ROW = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("x", T.StringType())]
)


def publish(spark, folder, rows):
    values = ", ".join(f"({i}, timestamp_ntz'2024-01-01 {h:02}:{m:02}:00', '{x}')" for i, h, m, x in rows)
    frame = spark.sql(f"SELECT * FROM VALUES {values} AS t(id, ts, x)").selectExpr("CAST(id AS BIGINT) id", "ts", "x")
    tables.publish(tables.envelope(frame, "t", "id").coalesce(1), folder)


def test_each_key_lands_once(spark, shared):
    folder, zone, progress = shared("bus"), shared("once"), shared("progress")

    def land():
        stream = bus.read_bus(spark, folder, ["t"], per_batch=1)
        return keyed.land_once(stream, "t", ROW, ["id"], "ts", "60 minutes", zone, progress)

    assert keyed.batches(spark, zone, ROW).count() == 0
    publish(spark, folder, [(1, 10, 0, "a"), (2, 10, 30, "a"), (2, 10, 30, "a")])
    publish(spark, folder, [(1, 10, 0, "again"), (3, 11, 0, "a")])
    assert land() == 0
    publish(spark, folder, [(3, 11, 0, "again"), (4, 11, 20, "a"), (5, 9, 0, "late"), (6, 9, 30, "late")])
    assert land() == 2 and land() == 0
    got = sorted((r.id, r.x) for r in keyed.batches(spark, zone, ROW).collect())
    assert got == [(1, "a"), (2, "a"), (3, "a"), (4, "a")]
    assert keyed.batches(spark, zone, ROW).schema["ts"].dataType == T.TimestampNTZType()


def test_newest_row_after_every_batch(spark, shared):
    folder, state, progress = shared("in"), shared("latest"), shared("progress")
    rng = random.Random(2)
    rows = [(rng.choice("abc"), n, rng.random()) for n in range(60)]
    rng.shuffle(rows)
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("at", T.LongType()), T.StructField("v", T.DoubleType())])
    assert keyed.newest(spark, state, schema, ["k"]).count() == 0
    for end in (10, 25, 60):
        start = {10: 0, 25: 10, 60: 25}[end]
        spark.createDataFrame(rows[start:end], schema).coalesce(1).write.mode("append").parquet(folder)
        keyed.land_latest(spark.readStream.schema(schema).parquet(folder), ["k"], ["at"], state, progress)
        want = latest(spark.createDataFrame(rows[:end], schema), ["k"], ["at"]).collect()
        assert sorted(keyed.newest(spark, state, schema, ["k"]).collect()) == sorted(want)


def test_payloads_of_any_shape(spark, shared):
    folder, zone, progress = shared("bus"), shared("open"), shared("progress")
    for values in ([("t", "1", '{"a": 1}'), ("t", "2", "no json {"), ("t", "3", None)], [("t", "4", '{"a": 2, "new": {"b": "x"}}'), ("o", "5", "{}")]):
        tables.publish(spark.createDataFrame(values, bus.ENVELOPE), folder)
        keyed.land_any(bus.read_bus(spark, folder, ["t"]), "t", zone, progress)
    landed = keyed.batches(spark, zone, keyed.VARIANTS)
    got = {r.key: (r.a, r.b) for r in landed.select("key", F.try_variant_get("v", "$.a", "int").alias("a"), F.try_variant_get("v", "$.new.b", "string").alias("b")).collect()}
    assert got == {"1": (1, None), "2": (None, None), "3": (None, None), "4": (2, "x")}
    assert "new" in keyed.shape_of(landed) and "b" in keyed.shape_of(landed)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_tables_are_joined_where_they_lie(spark, no_broadcast):
    from creditloom.queries import arrivals

    fact, clients = arrivals.bucketed_mart(spark, "/root/testdata/sf0.001")
    for joined in (fact.join(clients, "id"), fact.join(clients, "id", "left_anti")):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    plan = orphan_rows(fact, clients, "id")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(id" not in plan
    assert len(clients.inputFiles()) <= arrivals.BUCKETS


def test_broker_options(spark, monkeypatch):
    """What the reader and the writer of a broker are told; no broker is asked."""
    told = {}

    class Side:
        def __init__(self, side):
            self.side = side

        def format(self, fmt):
            told[self.side] = {"format": fmt}
            return self

        def options(self, **more):
            told[self.side].update(more)
            return self

        def option(self, key, value):
            told[self.side][key] = value
            return self

        def mode(self, mode):
            return self

        def load(self):
            return spark.createDataFrame([("t", b"k", b"v")], "topic string, key binary, value binary")

        def save(self):
            told["saved"] = True

    class Session:
        readStream = Side("read")

    got = bus.read_bus(Session(), "host:9092", ["a", "b"], "kafka", {"kafka.security.protocol": "SSL"}, per_batch=7)
    assert told["read"] == {
        "format": "kafka", "kafka.security.protocol": "SSL", "maxOffsetsPerTrigger": 7,
        "kafka.bootstrap.servers": "host:9092", "subscribe": "a,b", "startingOffsets": "earliest",
    }
    assert [tuple(r) for r in got.collect()] == [("t", "k", "v")]

    messages = tables.envelope(spark.range(3), "t", "id")
    monkeypatch.setattr(type(messages), "write", property(lambda self: Side("write")))
    monkeypatch.setattr(tables.Observation, "get", property(lambda self: {"rows": 3}))
    assert tables.publish(messages, "host:9092", "kafka", {"acks": "all"}) == 3
    assert told["write"] == {"format": "kafka", "acks": "all", "kafka.bootstrap.servers": "host:9092"} and told["saved"]
