"""Streams with state per key, payloads of open shape, and tables laid out by key."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from creditloom.bindings import ANCHOR_YEAR, credit_wide, table
from creditloom.operators.joins import orphan_rows
from creditloom.plans import mart as M
from creditloom.queries.flows import _EVENT, _LATEST
from creditloom.queries.registry import query
from creditloom.queries.sql import half_up, with_ctes
from creditloom.session import materialise, scratch_path
from creditloom.sinks import tables
from creditloom.streaming import bus, keyed
from creditloom.vocabulary import CREDIT_TOPIC

# --- each key once ---------------------------------------------------------------------------------------

_SPAN = (
    "span AS (SELECT min(epoch_us(ts)) AS first, max(epoch_us(ts)) AS last, "
    "(max(epoch_us(ts)) - min(epoch_us(ts))) // 8 AS delay FROM events), "
    "e AS (SELECT event_id, epoch_us(ts) AS us, first + 4 * delay AS middle, delay FROM events, span)"
)


@query(
    "stream_dedup",
    f"WITH {_SPAN} SELECT count(*) AS rows, count(DISTINCT event_id) AS events, "
    "count(*) FILTER (us <= middle - delay) AS late FROM e",
)
def stream_dedup(spark, sf):
    """Re-published events across batches and a restart land once; those beyond the delay are counted."""
    folder, zone, progress = (scratch_path(spark, n) for n in ("bus", "once", "progress"))
    events = table(spark, sf, "events").select(*_EVENT.names)
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(us), F.max(us)).first()
    delay = (last - first) // 8
    middle = first + 4 * delay
    late = 0
    runs = [
        # the first half; then the second half with repeats of what is not older than half a delay
        [us <= middle, (us > middle) | (us > middle - delay // 2)],
        # after a restart: repeats of the newest events, and of such that may have been forgotten
        [(us > last - delay // 2) | (us <= middle - delay)],
    ]
    for run in runs:
        for part in run:
            sent = tables.envelope(events.filter(part), CREDIT_TOPIC, "event_id")
            tables.publish(sent.coalesce(1), folder)  # a file is a batch here
        stream = bus.read_bus(spark, folder, [CREDIT_TOPIC], per_batch=1)
        late += keyed.land_once(
            stream, CREDIT_TOPIC, _EVENT, ["event_id"], "ts", f"{delay} microseconds", zone, progress
        )
    landed = keyed.batches(spark, zone, _EVENT)
    return landed.agg(
        F.count("*").alias("rows"), F.count_distinct("event_id").alias("events"), F.lit(late).cast("long").alias("late")
    )


_BATCH_RECORD = " UNION ALL ".join(
    f"SELECT '{CREDIT_TOPIC}' AS topic, CAST({batch} AS BIGINT) AS batch, count(*) AS received, "
    "count(*) FILTER (event_id % 10 <> 4) AS rows, count(*) FILTER (event_id % 10 = 4) AS undecodable, "
    f"CAST(2 AS BIGINT) AS zones FROM events WHERE event_id % 3 = {batch}"
    for batch in range(3)
)


@query("stream_batch_record", _BATCH_RECORD)
def stream_batch_record(spark, sf):
    """What each of three batches brought next to what landed of it in both zones; a tenth is no row."""
    folder, progress = scratch_path(spark, "bus"), scratch_path(spark, "progress")
    zones, layouts = [scratch_path(spark, z) for z in ("raw", "lake")], {CREDIT_TOPIC: ("csv", _EVENT)}
    events = tables.envelope(table(spark, sf, "events").select(*_EVENT.names), CREDIT_TOPIC, "event_id")
    number = F.col("key").cast("bigint")
    events = events.withColumn("value", F.when(number % 10 == 4, "no json {").otherwise(F.col("value")))
    for part in range(3):
        tables.publish(events.filter(number % 3 == part), folder)
        bus.land(bus.read_bus(spark, folder, [CREDIT_TOPIC]), zones, progress, layouts)
    return bus.batch_record(spark, zones, layouts)


@query(
    "export_record",
    "SELECT 'orders' AS \"table\", 'written' AS status, count(*) AS rows, false AS has_reason FROM orders UNION ALL "
    "SELECT 'absent', 'skipped', NULL, true UNION ALL "
    "SELECT 'parts', 'written', count(*), false FROM part",
)
def export_record(spark, sf):
    """An export of which one table is missing: the record says what became of each."""
    name = f"export_{uuid.uuid4().hex[:10]}"
    tables.rebuild_database(spark, name, scratch_path(spark, name))
    for t, source in (("orders", "orders"), ("parts", "part")):
        tables.save_table(table(spark, sf, source), f"{name}.{t}")
    record = scratch_path(spark, "record")
    tables.export_tables(spark, [name], ["orders", "absent", "parts"], scratch_path(spark, "exports"), record)
    read = spark.read.schema(tables.EXPORT).json(record)
    return read.select("table", "status", "rows", F.col("reason").isNotNull().alias("has_reason"))


# --- the newest row per key ----------------------------------------------------------------------------------


@query("stream_latest_metrics", _LATEST)
def stream_latest_metrics(spark, sf):
    """Latest metric per stage while records arrive out of order, over three batches and a restart."""
    folder, state, progress = (scratch_path(spark, n) for n in ("metrics", "latest", "progress"))
    records = table(spark, sf, "events").select(
        F.col("event_type").alias("pipeline"),
        F.concat(F.lit("s"), F.col("user_id") % 10).alias("stage"),
        F.lit("OK").alias("status"),
        F.col("event_id").alias("rows"),
        F.col("value").alias("duration_s"),
        F.round(F.col("value") * 2, 2).alias("peak_rss_mb"),
        "ts",
        "event_id",
    )
    keys = ["pipeline", "stage"]
    for parts in ([2, 0], [1]):
        for part in parts:
            records.filter(F.col("event_id") % 3 == part).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        keyed.land_latest(stream, keys, ["ts", "event_id"], state, progress)
    return keyed.newest(spark, state, records.schema, keys).select(
        *keys, "status", "rows", "duration_s", "peak_rss_mb"
    )


# --- payloads of any shape --------------------------------------------------------------------------------------


@query(
    "stream_open_payload",
    "SELECT CASE WHEN event_id % 4 = 3 THEN 'c' || (event_id % 5) END AS channel, count(*) AS messages, "
    "CAST(sum(user_id) AS BIGINT) AS users, round(sum(round(value * 100)::BIGINT) / 100, 2) AS amount, "
    "true AS in_schema FROM events GROUP BY 1",
)
def stream_open_payload(spark, sf):
    """Messages of the last batch carry a field that no schema knows; it lands, and can be asked for."""
    folder, zone, progress = (scratch_path(spark, n) for n in ("bus", "open", "progress"))
    events = table(spark, sf, "events").select("event_id", "user_id", "value")
    channel = F.concat(F.lit("c"), F.col("event_id") % 5)
    new = F.col("event_id") % 4 == 3
    for rows in (events.filter(~new), events.filter(new).withColumn("channel", channel)):
        tables.publish(tables.envelope(rows, CREDIT_TOPIC, "event_id"), folder)
        keyed.land_any(bus.read_bus(spark, folder, [CREDIT_TOPIC]), CREDIT_TOPIC, zone, progress)
    landed = keyed.batches(spark, zone, keyed.VARIANTS)
    named = "channel" in keyed.shape_of(landed)

    def asked(path, kind):
        return F.try_variant_get("v", path, kind)

    cents = F.sum(F.round(asked("$.value", "double") * 100).cast("bigint"))
    return landed.groupBy(asked("$.channel", "string").alias("channel")).agg(
        F.count("*").alias("messages"),
        F.sum(asked("$.user_id", "bigint")).alias("users"),
        F.round(cents / 100, 2).alias("amount"),
        F.lit(named).alias("in_schema"),
    )


# --- tables laid out by key --------------------------------------------------------------------------------------

BUCKETS = 16


def bucketed_mart(spark, sf):
    """Fact and clients of path B as tables in buckets by client; a tenth of the clients is left out."""
    name = f"bucketed_{uuid.uuid4().hex[:10]}"
    tables.rebuild_database(spark, name, scratch_path(spark, name))
    credit = materialise(credit_wide(spark, sf), "credit")
    tables.save_bucketed(M.elt_fact(credit, ANCHOR_YEAR), f"{name}.fact", ["id"], BUCKETS)
    tables.save_bucketed(M.demographics(credit).filter("id % 10 <> 0"), f"{name}.clients", ["id"], BUCKETS)
    return spark.table(f"{name}.fact"), spark.table(f"{name}.clients")


@query(
    "bucketed_client_join",
    with_ctes(
        "SELECT age_band, count(*) AS n_rows, count(DISTINCT f.id) AS clients, "
        f"{half_up('avg(round(f.bill_amt * 100)::BIGINT)', 2)} AS mean_cents FROM elt_fact f JOIN raw_clients c ON f.id = c.id "
        "WHERE c.id % 10 <> 0 GROUP BY age_band",
        "elt_fact",
        "raw_clients",
    ),
)
def bucketed_client_join(spark, sf):
    """Fact joined with its clients where both lie."""
    fact, clients = bucketed_mart(spark, sf)
    joined = fact.join(clients.select("id", "age_band"), "id")
    cents = F.round(F.col("bill_amt") * 100).cast("bigint")
    # one row per client first: the join leaves them together
    per_client = joined.groupBy("id", "age_band").agg(
        F.count("*").alias("n"), F.count(cents).alias("k"), F.sum(cents).alias("s")
    )
    mean = F.round((F.sum("s").cast("decimal(30,10)") / F.sum("k")).cast("decimal(30,10)"), 2).cast("double")
    return per_client.groupBy("age_band").agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("clients"), mean.alias("mean_cents")
    )


@query(
    "bucketed_orphans",
    with_ctes(
        "SELECT count(*) AS violations FROM elt_fact WHERE id % 10 = 0",
        "elt_fact",
    ),
)
def bucketed_orphans(spark, sf):
    """Fact rows without a client, counted where the tables lie."""
    fact, clients = bucketed_mart(spark, sf)
    return orphan_rows(fact, clients, "id")
