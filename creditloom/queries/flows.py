"""Windows, quality rules, the message leg, sampling and stage metrics."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.bindings import (
    ANCHOR_YEAR,
    client_events,
    credit_wide,
    macro_long,
    table,
)
from creditloom.operators import aggregates as A
from creditloom.operators import observe as O
from creditloom.operators import quality as Q
from creditloom.operators import sampling as Y
from creditloom.operators import windows as W
from creditloom.operators.joins import orphan_rows
from creditloom.operators.slices import SLICE_ROWS
from creditloom.plans import mart as M
from creditloom.queries.marts import clients_b, fact_b, macro_b
from creditloom.queries.registry import query
from creditloom.queries.sql import half_up, with_ctes
from creditloom.session import materialise, scratch_path
from creditloom.sinks import tables
from creditloom.sources import files
from creditloom.streaming import bus
from creditloom.vocabulary import (
    COMPOSITION_FLOOR,
    COMPOSITION_SPAN,
    CREDIT_TOPIC,
    MACRO_TOPIC,
    SCALED_INDICATORS,
    TARGET,
)

# --- windows ------------------------------------------------------------------------------------------


@query(
    "client_trends",
    with_ctes(
        "SELECT id, date_key, bill_amt, pay_amt, credit_utilization, "
        "lag(bill_amt) OVER w AS prev_bill_amt, "
        "round(bill_amt - lag(bill_amt) OVER w, 2) AS bill_mom_change, "
        + half_up(
            "avg(credit_utilization) OVER (PARTITION BY id ORDER BY date_key "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
            4,
        )
        + " AS run_avg_utilization, "
        "rank() OVER (PARTITION BY date_key ORDER BY bill_amt DESC NULLS LAST) "
        "AS bill_rank_in_month FROM elt_fact WINDOW w AS (PARTITION BY id ORDER BY date_key)",
        "elt_fact",
    ),
)
def client_trends(spark, sf):
    # Path B keeps its fact as a table; three passes read it here.
    trends = M.elt_trends(materialise(fact_b(spark, sf), "elt_fact"))
    return trends.withColumn("bill_mom_change", F.round("bill_mom_change", 2))


_TRENDS_SQL = (
    "SELECT user_id AS id, event_id, value AS amount, lag(value) OVER w AS previous, "
    "round(value - lag(value) OVER w, 2) AS change, "
    + half_up(
        "avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
        4,
    )
    + " AS running_avg "
    "FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"
)


def _trend_columns(df):
    return df.select(
        "id", "event_id", "amount", "previous", F.round("change", 2).alias("change"), "running_avg"
    )


@query("event_trends", _TRENDS_SQL)
def event_trends(spark, sf):
    events = client_events(spark, sf)
    return _trend_columns(W.running(events, "id", ["ts", "event_id"], "amount", "amount"))


@query("event_trends_sliced", _TRENDS_SQL)
def event_trends_sliced(spark, sf):
    """The same cut into 64 slices, as a table of 64 million events is, so that clients span several."""
    events, rows = client_events(spark, sf), 64 * SLICE_ROWS
    return _trend_columns(W.running(events, "id", ["ts", "event_id"], "amount", "amount", rows=rows))


_RANK_SQL = (
    "SELECT event_id, CAST(ts AS DATE) AS period, value AS amount, "
    "rank() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY value DESC NULLS LAST) AS place "
    "FROM events"
)


@query("rank_in_period", _RANK_SQL)
def rank_in_period(spark, sf):
    events = client_events(spark, sf).select("event_id", "period", "amount")
    return W.rank_in_group(events, "period", "amount", "place")


@query("rank_in_period_scaled", _RANK_SQL)
def rank_in_period_scaled(spark, sf):
    events = client_events(spark, sf).select("event_id", "period", "amount")
    return W.rank_in_group(events, "period", "amount", "place", hot_rows=50)


@query(
    "rank_capped_bills",
    with_ctes(
        "SELECT id, date_key, rank() OVER (PARTITION BY date_key "
        "ORDER BY coalesce(bill_amt, 0) DESC) AS place FROM elt_fact",
        "elt_fact",
    ),
)
def rank_capped_bills(spark, sf):
    """Many clients share the value 0 here; such a hot value is dealt over several parts."""
    bills = fact_b(spark, sf).select(
        "id", "date_key", F.coalesce("bill_amt", F.lit(0.0)).alias("bill_amt")
    )
    ranked = W.rank_in_group(bills, "date_key", "bill_amt", "place", hot_rows=50)
    return ranked.select("id", "date_key", "place")


def _scaled(c):
    return (
        f"({COMPOSITION_FLOOR} + {COMPOSITION_SPAN} * ({c} - min({c}) OVER ()) / CASE WHEN max({c}) OVER () = min({c}) OVER () "
        f"THEN 1.0 ELSE max({c}) OVER () - min({c}) OVER () END)"
    )


_SUMS = " + ".join(f"s_{c}" for c in SCALED_INDICATORS)
_SCALED = ", ".join(f"{_scaled(c)} AS s_{c}" for c in SCALED_INDICATORS)


@query(
    "macro_composition",
    with_ctes(
        "SELECT date_key, "
        + ", ".join(f"round(s_{c} / ({_SUMS}), 6) AS {c}_share" for c in SCALED_INDICATORS)
        + f" FROM (SELECT date_key, {_SCALED} FROM vs_macro)",
        "vs_macro",
    ),
)
def macro_composition(spark, sf):
    monthly = M.elt_default_vs_macro(fact_b(spark, sf), macro_b(spark, sf))
    shares = W.composition(monthly, SCALED_INDICATORS)
    return shares.select("date_key", *[f"{c}_share" for c in SCALED_INDICATORS])


@query(
    "macro_composition_cum",
    with_ctes(
        "SELECT date_key, "
        + ", ".join(
            f"round(({' + '.join('s_' + x for x in SCALED_INDICATORS[: i + 1])}) / ({_SUMS}), 6) "
            f"AS {c}_upper"
            for i, c in enumerate(SCALED_INDICATORS)
        )
        + f" FROM (SELECT date_key, {_SCALED} FROM macro_monthly)",
        "macro_monthly",
    ),
)
def macro_composition_cum(spark, sf):
    stacked = W.composition(macro_b(spark, sf), SCALED_INDICATORS)
    return stacked.select("date_key", *[f"{c}_upper" for c in SCALED_INDICATORS])


# --- stage metrics ---------------------------------------------------------------------------------------

_METRICS = (
    "SELECT event_type AS pipeline, 's' || (user_id % 10) AS stage, 'OK' AS status, "
    "event_id AS rows, value AS duration_s, round(value * 2, 2) AS peak_rss_mb, ts, event_id "
    "FROM events"
)
_LATEST = (
    "SELECT pipeline, stage, status, rows, duration_s, peak_rss_mb FROM (SELECT *, row_number() "
    f"OVER (PARTITION BY pipeline, stage ORDER BY ts DESC, event_id DESC) AS rn FROM ({_METRICS})) "
    "WHERE rn = 1"
)


def _latest_metrics(spark, sf):
    """Events stand in for metric records of several runs."""
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
    return W.latest(records, ["pipeline", "stage"], ["ts", "event_id"])


@query("metrics_latest", _LATEST)
def metrics_latest(spark, sf):
    return _latest_metrics(spark, sf).drop("ts", "event_id")


@query("metrics_table", _LATEST)
def metrics_table(spark, sf):
    return O.metrics_table(_latest_metrics(spark, sf))


@query(
    "path_summary",
    "SELECT p AS pipeline, round(sum(duration_s), 3) AS total_runtime_s, "
    "round(max(peak_rss_mb), 1) AS peak_rss_mb FROM (VALUES ('click'), ('purchase'), ('absent')) "
    f"AS v(p) LEFT JOIN ({_LATEST}) ON pipeline = p GROUP BY p",
)
def path_summary(spark, sf):
    return O.path_summary(_latest_metrics(spark, sf), ["click", "purchase", "absent"])


@query(
    "stage_metrics_log",
    with_ctes(
        "SELECT 'ELT' AS pipeline, 'transform' AS stage, 'OK' AS status, count(*) AS rows, "
        "'given tables' AS source, true AS timed FROM elt_fact",
        "elt_fact",
    ),
)
def stage_metrics_log(spark, sf):
    """A stage that writes the monthly fact, timed and counted; clock and memory only as being there."""
    log, out = scratch_path(spark, "metrics"), scratch_path(spark, "fact")
    with O.StageRun(spark, log, "ELT", "transform", source="given tables") as stage:
        tables.write_parquet(fact_b(spark, sf), out)
        stage.count_rows(spark.read.parquet(out))
    timed = (F.col("duration_s") > 0) & (F.col("peak_rss_mb") > 0) & F.col("ts").isNotNull()
    return O.read_metrics(spark, log).select(
        "pipeline", "stage", "status", "rows", F.col("extra")["source"].alias("source"), timed.alias("timed")
    )


@query("metrics_log_scan", _LATEST)
def metrics_log_scan(spark, sf):
    """The metric log as JSON lines with blank lines in between, read back; an absent log has no rows."""
    log = scratch_path(spark, "metrics")
    lines = _latest_metrics(spark, sf).drop("ts", "event_id").select(F.to_json(F.struct("*")).alias("value"))
    lines.unionByName(lines.select(F.lit("").alias("value"))).write.text(log)
    absent = O.read_metrics(spark, scratch_path(spark, "absent"))
    return O.metrics_table(O.read_metrics(spark, log).unionByName(absent))


@query(
    "comparison_csv",
    "SELECT p AS pipeline, round(sum(duration_s), 3) AS total_runtime_s, "
    "round(max(peak_rss_mb), 1) AS peak_rss_mb FROM (VALUES ('click'), ('purchase'), ('absent')) "
    f"AS v(p) LEFT JOIN ({_LATEST}) ON pipeline = p GROUP BY p",
)
def comparison_csv(spark, sf):
    """The comparison of the paths as CSV, read back."""
    path = scratch_path(spark, "comparison")
    totals = O.path_summary(_latest_metrics(spark, sf), ["click", "purchase", "absent"])
    tables.write_csv(totals, path)
    return files.read_csv(spark, path, totals.schema)


@query(
    "lines_per_source",
    "SELECT source, count(*) AS texts, CAST(sum(len(regexp_extract_all(text, '\\r\\n|[\\n\\r\\x0b"
    "\\x0c\\x1c\\x1d\\x1e\\x{85}\\x{2028}\\x{2029}]')) + CASE WHEN text = '' OR regexp_matches(text, "
    "'[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x{85}\\x{2028}\\x{2029}]\\z') THEN 0 ELSE 1 END) AS BIGINT) "
    "AS lines FROM documents GROUP BY source",
)
def lines_per_source(spark, sf):
    return O.lines_by(table(spark, sf, "documents"), "source", "text")


# --- quality rules ---------------------------------------------------------------------------------------

_PLANTED_SQL = (
    "planted AS (SELECT CASE WHEN id % 83 = 1 THEN NULL WHEN id % 97 = 2 THEN id + 1000000000000 "
    f"ELSE id END AS id, CASE WHEN id % 89 = 3 THEN date_key + 1200 ELSE date_key END AS date_key, "
    f"CASE WHEN id % 71 = 4 THEN 2 WHEN id % 71 = 5 THEN NULL ELSE {TARGET} END AS {TARGET}, "
    "credit_utilization, bill_amt, pay_amt, limit_bal FROM elt_fact UNION ALL "
    f"SELECT id, date_key, {TARGET}, credit_utilization, bill_amt, pay_amt, limit_bal "
    "FROM elt_fact WHERE id % 79 = 6)"
)


def _planted(spark, sf):
    """The path B fact with every kind of defect planted in it."""
    columns = [
        "id",
        "date_key",
        TARGET,
        "credit_utilization",
        "bill_amt",
        "pay_amt",
        "limit_bal",
    ]
    fact = fact_b(spark, sf).select(*columns)
    key = F.col("id")
    bad = fact.withColumns(
        {
            "id": F.when(key % 83 == 1, None).when(key % 97 == 2, key + 1000000000000).otherwise(key),
            "date_key": F.when(key % 89 == 3, F.col("date_key") + 1200).otherwise(
                F.col("date_key")
            ),
            TARGET: F.when(key % 71 == 4, 2).when(key % 71 == 5, None).otherwise(F.col(TARGET)),
        }
    )
    return bad.unionByName(fact.filter(key % 79 == 6))


def _with_planted(body):
    return with_ctes("", "elt_fact", "calendar").strip() + f", {_PLANTED_SQL} {body}"


_UNIQUE = (
    "SELECT count(*) AS v FROM (SELECT id, date_key FROM planted GROUP BY id, date_key "
    "HAVING count(*) > 1)"
)
_NULL_KEYS = "SELECT count(*) AS v FROM planted WHERE id IS NULL OR date_key IS NULL"
_BAD = f"SELECT count(*) AS v FROM planted WHERE {TARGET} NOT IN (0, 1)"
_NULL_USE = "SELECT count(*) AS v FROM planted WHERE credit_utilization IS NULL"
_ORPHAN_DATES = (
    "SELECT count(*) AS v FROM planted p WHERE NOT EXISTS "
    "(SELECT 1 FROM calendar c WHERE c.date_key = p.date_key)"
)
_ORPHAN_CLIENTS = (
    "SELECT count(*) AS v FROM planted p WHERE NOT EXISTS "
    "(SELECT 1 FROM credit_wide c WHERE c.id = p.id)"
)


@query(
    "dq_uniqueness",
    "SELECT count(*) AS violations FROM (SELECT l_orderkey, l_linenumber FROM lineitem "
    "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)",
)
def dq_uniqueness(spark, sf):
    return Q.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_single_pass",
    _with_planted(
        "SELECT count(*) AS n_rows, count(*) FILTER (id IS NULL OR date_key IS NULL) AS null_keys, "
        f"count(*) FILTER ({TARGET} NOT IN (0, 1)) AS bad_labels, "
        "count(*) FILTER (credit_utilization IS NULL) AS null_utilization, "
        "count(*) FILTER (credit_utilization < 0) AS negative_utilization FROM planted"
    ),
)
def dq_single_pass(spark, sf):
    return Q.fact_scan(_planted(spark, sf), ["id", "date_key"])


@query(
    "dq_range",
    _with_planted(
        f"SELECT count(*) FILTER ({TARGET} NOT IN (0, 1)) AS outside, "
        f"count(*) FILTER ({TARGET} IS NULL OR {TARGET} NOT IN (0, 1)) AS outside_strict "
        "FROM planted"
    ),
)
def dq_range(spark, sf):
    label = F.col(TARGET)
    return _planted(spark, sf).agg(
        F.count_if(Q.outside(label, [0, 1])).alias("outside"),
        F.count_if(Q.outside(label, [0, 1], null_is_outside=True)).alias("outside_strict"),
    )


@query(
    "dq_orphans",
    _with_planted(
        f"SELECT 'date_key' AS key, v AS violations FROM ({_ORPHAN_DATES}) UNION ALL "
        f"SELECT 'id', v FROM ({_ORPHAN_CLIENTS})"
    ),
)
def dq_orphans(spark, sf):
    fact = _planted(spark, sf)
    dims = {"date_key": M.calendar_year(spark, ANCHOR_YEAR), "id": credit_wide(spark, sf)}
    parts = [
        orphan_rows(fact, dim, key).select(F.lit(key).alias("key"), "violations")
        for key, dim in dims.items()
    ]
    return parts[0].unionByName(parts[1])


_NEGATIVE_USE = "SELECT count(*) AS v FROM planted WHERE credit_utilization < 0"
_RULES = (
    f"SELECT 'uniqueness_id_date' AS rule, v AS violations, NULL AS details FROM ({_UNIQUE}) UNION ALL "
    f"SELECT 'not_null_keys', v, NULL FROM ({_NULL_KEYS}) UNION ALL "
    f"SELECT 'range_checks', ({_BAD}) + ({_NULL_USE}), "
    f"'{{\"neg_utilization_kept\":' || ({_NEGATIVE_USE}) || '}}' UNION ALL "
    "SELECT 'dtype_consistency', 0, '{\"types\":[\"double\"]}' UNION ALL "
    f"SELECT 'referential_integrity', ({_ORPHAN_DATES}) + ({_ORPHAN_CLIENTS}), '{{\"orphan_dates\":' "
    f"|| ({_ORPHAN_DATES}) || ',\"orphan_clients\":' || ({_ORPHAN_CLIENTS}) || '}}' UNION ALL "
    f"SELECT 'distribution_default_rate', CASE WHEN avg({TARGET}) > 0 AND avg({TARGET}) < 1 "
    f"THEN 0 ELSE 1 END, '{{\"default_rate\":' || round(avg({TARGET}), 4) || '}}' FROM credit_wide"
)


@query(
    "dq_report",
    _with_planted(
        f"SELECT rule, CAST(violations AS BIGINT) AS violations, details, violations = 0 AS pass "
        f"FROM ({_RULES})"
    ),
)
def dq_report(spark, sf):
    return Q.rule_report(
        _planted(spark, sf), clients_b(spark, sf), M.calendar_year(spark, ANCHOR_YEAR)
    )


@query(
    "dq_report_file",
    _with_planted(
        f"SELECT rule, CAST(violations AS BIGINT) AS violations, details, violations = 0 AS pass "
        f"FROM ({_RULES})"
    ),
)
def dq_report_file(spark, sf):
    """The report as a JSON file, read back."""
    report, path = dq_report(spark, sf), scratch_path(spark, "report")
    tables.write_report(report, path)
    return spark.read.schema(report.schema).json(path)


@query(
    "dq_gate",
    _with_planted(
        f"SELECT count(*) AS rules, bool_and(violations = 0) AS all_pass FROM ({_RULES})"
    ),
)
def dq_gate(spark, sf):
    return Q.gate(dq_report(spark, sf))


# --- the message leg ---------------------------------------------------------------------------------------

_EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("props", T.StringType()),
    ]
)
_OBSERVATION = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("series_id", "obs_date", "value")]
)
_LAYOUTS = {CREDIT_TOPIC: ("csv", _EVENT), MACRO_TOPIC: ("json", _OBSERVATION)}


def _published(spark, sf):
    """Events and observations as one keyed stream of messages."""
    folder = scratch_path(spark, "bus")
    events = table(spark, sf, "events").select(*_EVENT.names)
    tables.publish(tables.envelope(events, CREDIT_TOPIC, "user_id"), folder)
    tables.publish(tables.envelope(macro_long(spark, sf), MACRO_TOPIC, "series_id"), folder)
    return bus.read_bus(spark, folder, list(_LAYOUTS))


def _landed(spark, sf):
    zones = [scratch_path(spark, "raw"), scratch_path(spark, "datalake")]
    bus.land(_published(spark, sf), zones, scratch_path(spark, "progress"), _LAYOUTS)
    return zones


def _stamped(events):
    """Time as text with all its digits, so that it compares whatever the session's zone is."""
    return events.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def _read(spark, zone, topic):
    fmt, schema = _LAYOUTS[topic]
    return bus.landed(spark, zone, topic, fmt, schema)


@query(
    "stream_demux_credit", "SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, props FROM events"
)
def stream_demux_credit(spark, sf):
    return _stamped(_read(spark, _landed(spark, sf)[0], CREDIT_TOPIC))


@query(
    "stream_demux_macro",
    with_ctes("SELECT series_id, obs_date, value FROM macro_long", "macro_long"),
)
def stream_demux_macro(spark, sf):
    return _read(spark, _landed(spark, sf)[0], MACRO_TOPIC)


@query(
    "stream_fanout_parity",
    with_ctes(
        f"SELECT '{CREDIT_TOPIC}' AS topic, count(*) AS raw_rows, count(*) AS lake_rows, "
        "CAST(0 AS BIGINT) AS only_raw, CAST(0 AS BIGINT) AS only_lake FROM events UNION ALL "
        f"SELECT '{MACRO_TOPIC}', count(*), count(*), 0, 0 FROM macro_long",
        "macro_long",
    ),
)
def stream_fanout_parity(spark, sf):
    raw, lake = _landed(spark, sf)
    parts = []
    for topic in _LAYOUTS:
        both = _read(spark, raw, topic).withColumn("side", F.lit(1)).unionByName(
            _read(spark, lake, topic).withColumn("side", F.lit(-1))
        )
        # Copies are counted per row with a sign: one shuffle for both differences.
        net = both.groupBy(*_LAYOUTS[topic][1].names).agg(
            F.sum("side").alias("net"),
            F.count_if(F.col("side") == 1).alias("raw"),
            F.count_if(F.col("side") == -1).alias("lake"),
        )
        parts.append(
            net.agg(
                F.sum("raw").alias("raw_rows"),
                F.sum("lake").alias("lake_rows"),
                F.sum(F.when(F.col("net") > 0, F.col("net")).otherwise(0)).alias("only_raw"),
                F.sum(F.when(F.col("net") < 0, -F.col("net")).otherwise(0)).alias("only_lake"),
            ).select(F.lit(topic).alias("topic"), "*")
        )
    return parts[0].unionByName(parts[1])


_CREDIT_SQL = (
    f"SELECT '{CREDIT_TOPIC}' AS topic, count(*) AS messages, CAST(0 AS BIGINT) AS changed, "
    "CAST(0 AS BIGINT) AS undecodable, count(*) AS rows FROM credit_wide"
)


@query(
    "stream_payload_intact",
    with_ctes(
        f"{_CREDIT_SQL} UNION ALL SELECT '{MACRO_TOPIC}', count(*), 0, 0, count(*) FROM macro_long",
        "credit_wide",
        "macro_long",
    ),
)
def stream_payload_intact(spark, sf):
    """Whole client records and observations: every text lands in both zones as it was published."""
    folder, progress = scratch_path(spark, "bus"), scratch_path(spark, "progress")
    zones = [scratch_path(spark, "raw"), scratch_path(spark, "datalake")]
    credit = materialise(credit_wide(spark, sf), "credit")
    layouts = {CREDIT_TOPIC: ("csv", credit.schema), MACRO_TOPIC: ("json", _OBSERVATION)}
    tables.publish(tables.envelope(credit, CREDIT_TOPIC, "id"), folder)
    tables.publish(tables.envelope(macro_long(spark, sf), MACRO_TOPIC, "series_id"), folder)
    bus.land(bus.read_bus(spark, folder, list(layouts)), zones, progress, layouts)
    sent = spark.read.schema(bus.ENVELOPE).parquet(folder)
    parts = []
    for topic, (fmt, schema) in layouts.items():
        # each text counts +1 as sent and -1/2 per zone: what does not cancel out was changed or lost
        net = sent.filter(F.col("topic") == topic).select("key", "value", F.lit(2).alias("n"))
        bad = 0
        for zone in zones:
            got = bus.received(spark, zone, topic)
            net = net.unionByName(got.select("key", "value", F.lit(-1).alias("n")))
            bad += bus.received(spark, zone, topic, bus.UNDECODABLE).agg(F.count("*").alias("n")).scalar()
        rows = bus.landed(spark, zones[1], topic, fmt, schema).agg(F.count("*").alias("n")).scalar()
        changed = net.groupBy("key", "value").agg(F.sum("n").alias("n"), F.count_if(F.col("n") == 2).alias("m"))
        parts.append(
            changed.agg(F.sum("m").alias("messages"), F.count_if(F.col("n") != 0).alias("changed")).select(
                F.lit(topic).alias("topic"), "messages", "changed", bad.alias("undecodable"), rows.alias("rows")
            )
        )
    return parts[0].unionByName(parts[1])


@query(
    "stream_bad_messages",
    "SELECT count(*) AS messages, count(*) FILTER (event_id % 10 >= 3) AS rows, "
    "count(*) FILTER (event_id % 10 < 3) AS undecodable, "
    "count(*) FILTER (event_id % 10 = 0) AS not_json FROM events",
)
def stream_bad_messages(spark, sf):
    """Texts that are no JSON, a wrong type, and no text at all: kept as received and told apart."""
    folder, progress = scratch_path(spark, "bus"), scratch_path(spark, "progress")
    zones = [scratch_path(spark, "raw"), scratch_path(spark, "datalake")]
    events = tables.envelope(table(spark, sf, "events"), CREDIT_TOPIC, "event_id")
    kind = F.col("key").cast("bigint") % 10
    broken = (
        F.when(kind == 0, F.lit("no json {"))
        .when(kind == 1, F.lit('{"event_id": "one", "value": 2}'))
        .when(kind == 2, F.lit(None))
        .otherwise(F.col("value"))
    )
    tables.publish(events.withColumn("value", broken), folder)
    layouts = {CREDIT_TOPIC: _LAYOUTS[CREDIT_TOPIC]}
    bus.land(bus.read_bus(spark, folder, list(layouts)), zones, progress, layouts)
    rows = _read(spark, zones[1], CREDIT_TOPIC).agg(F.count("*").alias("n")).scalar()
    bad = bus.received(spark, zones[1], CREDIT_TOPIC, bus.UNDECODABLE)
    counts = bad.agg(F.count("*").alias("n"), F.count_if(F.col("value") == "no json {").alias("j"))
    return bus.received(spark, zones[1], CREDIT_TOPIC).agg(F.count("*").alias("messages")).select(
        "messages",
        rows.alias("rows"),
        counts.select("n").scalar().alias("undecodable"),
        counts.select("j").scalar().alias("not_json"),
    )


@query(
    "stream_restart",
    "SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, props FROM events",
)
def stream_restart(spark, sf):
    """Half of the events, a second run over the rest, a third that finds nothing: each lands once."""
    folder, progress = scratch_path(spark, "bus"), scratch_path(spark, "progress")
    zone = scratch_path(spark, "raw")
    layouts = {CREDIT_TOPIC: _LAYOUTS[CREDIT_TOPIC]}
    events = tables.envelope(table(spark, sf, "events"), CREDIT_TOPIC, "event_id")
    half = F.col("key").cast("bigint") % 2
    for run in (events.filter(half == 0), events.filter(half == 1), None):
        if run is not None:
            tables.publish(run, folder)
        bus.land(bus.read_bus(spark, folder, [CREDIT_TOPIC]), [zone], progress, layouts)
    return _stamped(_read(spark, zone, CREDIT_TOPIC))


@query(
    "stream_topic_counts",
    with_ctes(
        f"SELECT '{CREDIT_TOPIC}' AS topic, count(*) AS messages FROM events UNION ALL "
        f"SELECT '{MACRO_TOPIC}', count(*) FROM macro_long",
        "macro_long",
    ),
)
def stream_topic_counts(spark, sf):
    return bus.topic_counts(
        _published(spark, sf), scratch_path(spark, "counts"), scratch_path(spark, "progress")
    )


# --- sampling -----------------------------------------------------------------------------------------------

# Output rows per source row, and the seed.
_GROWTH = 5
_SEED = 42

_QUOTA = (
    "SELECT {label} AS {label}, count(*) AS rows, CAST(round_even(count(*)::DOUBLE / "
    "sum(count(*)) OVER () * {size}, 0) AS BIGINT) AS quota FROM {source} GROUP BY {label}"
)


@query(
    "class_quota",
    _QUOTA.format(label="quality", size="150000", source="labels"),
)
def class_quota(spark, sf):
    return Y.class_quota(table(spark, sf, "labels"), "quality", 150_000)


@query(
    "class_quota_balanced",
    "SELECT toxic, count(*) AS rows, CAST(150001 // count(*) OVER () AS BIGINT) AS quota "
    "FROM labels GROUP BY toxic",
)
def class_quota_balanced(spark, sf):
    return Y.class_quota(table(spark, sf, "labels"), "toxic", 150_001, balanced=True)


@query(
    "class_balance",
    "SELECT quality, count(*) AS rows, round(count(*)::DOUBLE / sum(count(*)) OVER (), 4) AS share "
    "FROM labels GROUP BY quality",
)
def class_balance(spark, sf):
    return A.shares(table(spark, sf, "labels"), "quality")


def _drawn(spark, sf, clients, seed=_SEED, balanced=False):
    """Whole rows (all 25 columns) drawn to the quota; the key is still that of the source."""
    size = _GROWTH * table(spark, sf, "customer").count()
    return Y.resample(clients, ["id"], TARGET, size, seed, balanced)


def _resampled(spark, sf):
    clients = materialise(credit_wide(spark, sf), "clients")
    return Y.draw_as_key(_drawn(spark, sf, clients), "id", "id")


_QUOTA_OF_CLIENTS = _QUOTA.format(
    label=TARGET, size=f"{_GROWTH} * (SELECT count(*) FROM customer)", source="credit_wide"
)


@query(
    "stratified_resample",
    with_ctes(
        f"SELECT {TARGET}, quota AS rows, CAST(0 AS BIGINT) AS unlike_source, quota AS draws "
        f"FROM ({_QUOTA_OF_CLIENTS})",
        "credit_wide",
    ),
)
def stratified_resample(spark, sf):
    """Drawn rows per class, and those of them that differ from the source row in any column."""
    clients = materialise(credit_wide(spark, sf), "clients")
    drawn = _drawn(spark, sf, clients)
    source = clients.select(F.col("id").alias("__id"), F.struct(*clients.columns).alias("__source"))
    joined = drawn.join(source, F.col("id") == F.col("__id"), "left")
    same = F.struct(*clients.columns).eqNullSafe(F.col("__source"))
    return joined.groupBy(TARGET).agg(
        F.count("*").alias("rows"),
        F.count_if(~same).alias("unlike_source"),
        F.count_distinct("draw").alias("draws"),
    )


@query(
    "resample_repeats",
    with_ctes(
        f"SELECT {TARGET}, CAST(0 AS BIGINT) AS other_picks, true AS seed_matters "
        "FROM (SELECT DISTINCT " + TARGET + " FROM credit_wide)",
        "credit_wide",
    ),
)
def resample_repeats(spark, sf):
    """The same seed draws the same rows from other partitions, another seed draws others."""
    clients = materialise(credit_wide(spark, sf), "clients")
    again = clients.repartition(3)
    picks = [
        _drawn(spark, sf, df, seed).select(TARGET, "draw", F.col("id").alias(f"id_{n}"))
        for n, (df, seed) in enumerate(((clients, _SEED), (again, _SEED), (clients, _SEED + 1)))
    ]
    both = picks[0].join(picks[1], [TARGET, "draw"]).join(picks[2], [TARGET, "draw"])
    return both.groupBy(TARGET).agg(
        F.count_if(F.col("id_0") != F.col("id_1")).alias("other_picks"),
        (F.count_if(F.col("id_0") != F.col("id_2")) > 0).alias("seed_matters"),
    )


@query(
    "resample_quota_check",
    with_ctes(
        f"SELECT {TARGET}, quota AS rows FROM ("
        + _QUOTA.format(
            label=TARGET,
            size=f"{_GROWTH} * (SELECT count(*) FROM customer)",
            source="credit_wide",
        )
        + ")",
        "credit_wide",
    ),
)
def resample_quota_check(spark, sf):
    return _resampled(spark, sf).groupBy(TARGET).agg(F.count("*").alias("rows"))


@query(
    "surrogate_ids",
    with_ctes(
        "SELECT CAST(1 AS BIGINT) AS first_id, CAST(sum(quota) AS BIGINT) AS last_id, "
        "CAST(sum(quota) AS BIGINT) AS distinct_ids, CAST(sum(quota) AS BIGINT) AS rows FROM ("
        + _QUOTA.format(
            label=TARGET,
            size=f"{_GROWTH} * (SELECT count(*) FROM customer)",
            source="credit_wide",
        )
        + ")",
        "credit_wide",
    ),
)
def surrogate_ids(spark, sf):
    return _resampled(spark, sf).agg(
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.count_distinct("id").alias("distinct_ids"),
        F.count("*").alias("rows"),
    )


@query(
    "surrogate_ids_of_table",
    "SELECT CAST(1 AS BIGINT) AS first_id, count(*) AS last_id, count(*) AS distinct_ids, "
    "count(*) AS rows, CAST(sum(o_totalprice > 0) AS BIGINT) AS priced FROM orders",
)
def surrogate_ids_of_table(spark, sf):
    """New dense ids for a table that has a key but no dense one."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    fresh = Y.replace_key(orders, "o_orderkey", "id", ["o_orderkey"])
    return fresh.agg(
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.count_distinct("id").alias("distinct_ids"),
        F.count("*").alias("rows"),
        F.count_if(F.col("o_totalprice") > 0).alias("priced"),
    )
