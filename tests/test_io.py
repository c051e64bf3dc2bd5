"""Sources, sinks, the message leg and stage metrics."""

import json
import logging

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions import scalars as S
from creditloom.operators import observe as O
from creditloom.sinks import tables
from creditloom.sources import files
from creditloom.streaming import bus


def test_first_existing_source(spark, shared):
    folder = shared("in")
    tables.write_csv(spark.range(3).withColumn("PAY-0", F.lit(1)), f"{folder}/second")
    found = files.read_credit(spark, [f"{folder}/first", f"{folder}/second"])
    assert found.columns == ["id", "pay_0"] and found.count() == 3
    with pytest.raises(FileNotFoundError):
        files.first_existing(spark, [f"{folder}/none"])


def test_nested_series_files(spark, tmp_path):
    for series, values in {"EXTAUS": ["32.0", "."], "RBTWBIS": ["101.5", None]}.items():
        document = {
            "units": "x",
            "count": 2,
            "observations": [
                {"date": f"2005-0{i}-01", "value": v, "realtime_start": "a", "realtime_end": "b"}
                for i, v in enumerate(values, 1)
            ],
        }
        path = tmp_path / f"fred_{series}_2005.json"
        path.write_text(json.dumps(document, indent=2))
    got = files.read_series_files(
        spark,
        lambda s: f"{tmp_path}/fred_{s}_2005.json",
        ["EXTAUS", "RBTWBIS", "NBTWBIS"],
        r"fred_([A-Z0-9]+)_2005",
    )
    rows = {(r.series_id, r.obs_date): r.value for r in got.collect()}
    assert rows == {
        ("EXTAUS", "2005-01-01"): "32.0",
        ("EXTAUS", "2005-02-01"): ".",
        ("RBTWBIS", "2005-01-01"): "101.5",
        ("RBTWBIS", "2005-02-01"): None,
    }
    none = files.read_series_files(spark, lambda s: f"{tmp_path}/no_{s}", ["A"], "x")
    assert none.count() == 0


def test_numbers_kept_as_text(spark):
    texts = ["3.0", "2.5", "abc", None, "", "1e3", "Infinity", "NaN", "1e300", "-4.0"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.select(S.number_or_text(F.col("v"))).collect()]
    assert got == ["3", "2.5", "abc", None, "", "1000", "Infinity", "NaN", "1e300", "-4"]


def test_absent_kpi_file_reads_empty(spark, shared):
    assert files.read_text_numbers(spark, shared("nothing"), ["a", "b"]).count() == 0


@pytest.mark.parametrize(
    "text, lines",
    [("", 0), ("a", 1), ("a\n", 1), ("a\nb", 2), ("a\r\nb\r\n", 2), ("\n\n", 2), ("a\rb\x85c", 3)],
)
def test_line_count(spark, text, lines):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(S.line_count(F.col("t"))).first()[0] == lines == len(text.splitlines())


def test_rebuild_is_repeatable_and_lists_tables(spark, shared):
    for _ in range(2):
        tables.rebuild_database(spark, "test_rebuild", shared("db"))
        tables.save_table(spark.range(2), "test_rebuild.kpi_one")
        tables.create_as(spark, "test_rebuild.kpi_two", "SELECT 1 AS x")
        tables.save_table(spark.range(1), "test_rebuild.other")
    names = {r.tableName for r in tables.list_tables(spark, "test_rebuild", "kpi*").collect()}
    assert names == {"kpi_one", "kpi_two"}


def test_export_goes_on_after_a_missing_table(spark, shared, caplog):
    tables.rebuild_database(spark, "test_export", shared("db"))
    tables.save_table(spark.range(2), "test_export.there")
    with caplog.at_level(logging.WARNING):
        written = tables.export_tables(spark, ["test_export"], ["gone", "there"], shared("out"))
    assert list(written) == ["test_export__there"]
    assert "test_export__gone" in caplog.text


PAYLOAD = T.StructType(
    [T.StructField("k", T.LongType()), T.StructField("text", T.StringType())]
)
LAYOUTS = {"one": ("csv", PAYLOAD), "two": ("json", PAYLOAD)}


def _publish(spark, folder, topic, first, last):
    rows = spark.range(first, last).select(
        F.col("id").alias("k"), F.concat(F.lit('say "x", '), F.col("id")).alias("text")
    )
    assert tables.publish(tables.envelope(rows, topic, "k"), folder) == last - first


def test_restarted_stream_neither_loses_nor_repeats(spark, shared):
    folder, progress = shared("bus"), shared("progress")
    zones = [shared("raw"), shared("lake")]
    _publish(spark, folder, "one", 0, 10)
    _publish(spark, folder, "two", 0, 4)

    real_save = bus.decoded
    calls = []

    def failing(messages, topic, schema):
        calls.append(topic)
        if topic == "two" and len(calls) < 3:
            raise RuntimeError("executor lost")
        return real_save(messages, topic, schema)

    bus.decoded = failing
    try:
        with pytest.raises(Exception, match="executor lost"):
            bus.land(bus.read_bus(spark, folder, list(LAYOUTS)), zones, progress, LAYOUTS)
    finally:
        bus.decoded = real_save

    _publish(spark, folder, "one", 10, 15)
    for _ in range(2):  # the second run finds nothing new
        messages = bus.read_bus(spark, folder, list(LAYOUTS), per_batch=1)
        bus.land(messages, zones, progress, LAYOUTS)
    for zone in zones:
        one = bus.landed(spark, zone, "one", "csv", PAYLOAD)
        two = bus.landed(spark, zone, "two", "json", PAYLOAD)
        assert sorted(r.k for r in one.collect()) == list(range(15))
        assert sorted(r.k for r in two.collect()) == list(range(4))
        assert one.filter("k = 3").first().text == 'say "x", 3'


def test_topic_without_messages_reads_empty(spark, shared):
    assert bus.landed(spark, shared("zone"), "one", "csv", PAYLOAD).count() == 0


def test_trial_run_publishes_the_first_rows_by_key(spark):
    rows = spark.range(20).select((19 - F.col("id")).alias("k"))
    few = tables.envelope(rows, "t", "k", limit=3)
    assert sorted(r.key for r in few.collect()) == ["0", "1", "2"]


def test_topic_counts(spark, shared):
    folder = shared("bus")
    _publish(spark, folder, "one", 0, 6)
    _publish(spark, folder, "two", 0, 2)
    _publish(spark, folder, "three", 0, 9)
    counts = bus.topic_counts(
        bus.read_bus(spark, folder, ["one", "two"]), shared("sink"), shared("progress")
    )
    assert {r.topic: r.messages for r in counts.collect()} == {"one": 6, "two": 2}


def test_stage_runs_are_logged(spark, shared):
    log = shared("metrics")
    assert O.read_metrics(spark, log).count() == 0
    with O.StageRun(spark, log, "ETL", "transform", source="x") as stage:
        tables.write_parquet(spark.range(7), shared("out"))
        stage.count_rows(spark.range(7))
    with pytest.raises(ValueError, match="boom"):
        with O.StageRun(spark, log, "ETL", "load"):
            raise ValueError("boom")
    with O.StageRun(spark, log, "ETL", "nothing"):
        pass
    rows = {r.stage: r for r in O.read_metrics(spark, log).collect()}
    assert (rows["transform"].status, rows["transform"].rows) == ("OK", 7)
    assert rows["transform"].extra == {"source": "x"} and rows["nothing"].rows is None
    assert (rows["load"].status, rows["load"].extra["error"]) == ("FAILED", "boom")
    assert all(r.duration_s >= 0 and r.ts and r.peak_rss_mb > 1 for r in rows.values())


def test_bad_messages_are_kept_apart(spark, shared):
    folder = shared("bus")
    texts = ['{"k": 1, "text": "a", "more": [1]}', "no json", '{"k": "x", "text": "b"}', None, '{"k": 2}']
    sent = spark.createDataFrame([("one", str(i), t) for i, t in enumerate(texts)], bus.ENVELOPE)
    tables.publish(sent, folder)
    zones = [shared("raw"), shared("lake")]
    bus.land(bus.read_bus(spark, folder, ["one"]), zones, shared("progress"), LAYOUTS)
    for zone in zones:
        rows = bus.landed(spark, zone, "one", "csv", PAYLOAD).collect()
        assert sorted((r.k, r.text) for r in rows) == [(1, "a"), (2, None)]
        assert {r.value for r in bus.received(spark, zone, "one").collect()} == set(texts)
        bad = bus.received(spark, zone, "one", bus.UNDECODABLE).collect()
        assert sorted(r.key for r in bad) == ["1", "2", "3"]
    assert bus.received(spark, zones[0], "absent").count() == 0


def test_values_that_a_type_cannot_hold_are_counted(spark, shared):
    path = shared("csv")
    text = spark.createDataFrame(
        [("1", "2.0", " 3 "), ("2.5", "x", "4e1"), ("", None, "1.25"), ("99999999999", "-1", "")],
        "a string, b string, c string",
    )
    tables.write_csv(text, path)
    kinds = {"a": "int", "b": "int", "c": "double"}
    read = files.read_credit_text(spark, [path])
    rows = files.typed(read, kinds.get).collect()
    assert {(r.a, r.b, r.c) for r in rows} == {(1, 2, 3.0), (None, None, 40.0), (None, None, 1.25), (None, -1, None)}
    lost = {r.column: r.lost for r in files.lost_values(read, kinds.get).collect()}
    assert lost == {"a": 2, "b": 1, "c": 0}


def test_scratch_is_dropped_by_its_owner(spark, shared):
    from creditloom import session

    kept = session.materialise(spark.range(3), "kept")
    assert kept.count() == 3
    root = f"{session.shared_root(spark)}/creditloom/{spark.sparkContext.applicationId}"
    assert files.path_exists(spark, root)
    session.drop_scratch(spark)
    assert not files.path_exists(spark, root)


def test_summary_has_absent_pipelines(spark):
    rows = [("ETL", "a", 1.5, 10.0), ("ETL", "b", 2.0, 30.0)]
    latest = spark.createDataFrame(
        rows, "pipeline string, stage string, duration_s double, peak_rss_mb double"
    )
    got = {r.pipeline: r for r in O.path_summary(latest, ["ETL", "ELT"]).collect()}
    assert (got["ETL"].total_runtime_s, got["ETL"].peak_rss_mb) == (3.5, 30.0)
    assert got["ELT"].total_runtime_s is None
