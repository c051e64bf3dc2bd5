"""Both paths end to end from a CSV and nested JSON files."""

import json

import pytest
from pyspark.sql import functions as F

from creditloom import session
from creditloom.operators.observe import read_metrics
from creditloom.plans import jobs
from creditloom.plans import kpi as K
from creditloom.sinks.tables import EXPORT
from creditloom.sources.files import read_text_numbers
from creditloom.vocabulary import BILL_COLUMNS, PAYMENT_COLUMNS, SERIES_COLUMNS

HEADER = (
    ["ID", "LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE"]
    + [f"PAY_{i}" for i in (0, 2, 3, 4, 5, 6)]
    + [c.upper() for c in BILL_COLUMNS + PAYMENT_COLUMNS]
    + ["default payment next month"]
)


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    raw = tmp_path_factory.mktemp("raw")
    lines = [",".join(HEADER)]
    for i in range(1, 61):
        row = [i, 1000 * (i % 7), i % 3, i % 6, i % 4, 15 + i]
        row += [(i + m) % 4 - 1 for m in range(6)]
        row += [round(100.5 * ((i * (m + 3)) % 41) - 300, 2) for m in range(6)]
        row += ["" if i % 20 == 0 else 10 * (i % (m + 5)) for m in range(6)]
        lines.append(",".join(map(str, [*row, int(i % 5 == 0)])))
    (raw / "clients.csv").write_text("\n".join(lines) + "\n")
    for n, series in enumerate(list(SERIES_COLUMNS)[:3]):
        months = [
            {"date": f"2005-{m:02d}-01", "value": "." if m == 6 + n else str(30 + n + m / 10)}
            for m in range(1, 13)
        ]
        path = raw / f"fred_{series}_2005.json"
        path.write_text(json.dumps({"observations": months}, indent=1))
    work = str(tmp_path_factory.mktemp("work"))
    return jobs.Job(
        [f"{raw}/absent.csv", f"{raw}/clients.csv"], str(raw), 2005, work, "job_a", "job_b"
    )


def test_all_steps(spark, job):
    assert jobs.run_path_a(spark, job) is True
    jobs.run_path_b(spark, job)

    fact = spark.table("job_a.fact_credit_monthly")
    assert fact.count() == 360 and fact.filter("pay_amt IS NULL").count() == 0
    landed = spark.table("job_b.elt_fact_monthly")
    assert landed.count() == 360 and landed.filter("pay_amt IS NULL").count() == 18

    keys = ["dimension", "category"]
    a, b = (spark.table(f"job_{x}.kpi_default_by_demographic") for x in "ab")
    same = K.parity(a, b, keys, {"clients": 0, "default_rate": 0.0001})
    assert same.filter(~F.col("agrees")).count() == 0 and same.count() == a.count()
    first, second = (spark.table(f"job_{x}.kpi_overall").first() for x in "ab")
    assert first.asDict() == second.asDict() == {"default_rate": 0.2, "total_clients": 60}

    assert jobs.export(spark, job) is True
    record = spark.read.schema(EXPORT).json(f"{job.work}/export_record").collect()
    assert len(record) == 8 and all(r.status == "written" and r.rows > 0 for r in record)
    rows = read_text_numbers(spark, f"{job.work}/exports/job_a__kpi_overall", ["default_rate", "total_clients"])
    assert rows.first().asDict() == {"default_rate": "0.2", "total_clients": "60"}
    # a KPI table that is gone is told by the job's exit
    spark.sql("DROP TABLE job_b.kpi_overall")
    assert jobs.export(spark, job) is False
    gone = [r for r in spark.read.schema(EXPORT).json(f"{job.work}/export_record").collect() if r.status == "skipped"]
    assert [(r.database, r.table, r.rows) for r in gone] == [("job_b", "kpi_overall", None)] and gone[0].reason

    totals = {r.pipeline: r.total_runtime_s for r in jobs.compare(spark, job).collect()}
    assert totals["ETL"] > 0 and totals["ELT"] > 0
    logged = {(r.pipeline, r.stage): r.rows for r in read_metrics(spark, job.log).collect()}
    assert logged["ETL", "load"] == 360 and logged["ELT", "extract_load"] == 60 + 36


def test_rules_decide_the_verdict(spark, job, tmp_path):
    text = open(job.credit[1]).read().splitlines()
    broken = [line.rsplit(",", 1)[0] + ",7" for line in text[1:]]
    (tmp_path / "bad.csv").write_text("\n".join([text[0], *broken]) + "\n")
    bad = jobs.Job([f"{tmp_path}/bad.csv"], job.macro, 2005, f"{tmp_path}/w", "bad_a", "bad_b")
    assert jobs.run_path_a(spark, bad) is False
    report = {r["rule"]: r["pass"] for r in spark.read.json(f"{bad.work}/validation_report").collect()}
    assert not report["range_checks"] and not report["distribution_default_rate"]
    assert report["referential_integrity"]


class _Cluster:
    """Stands in for a session on a cluster without the shared folder setting."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "spark://host:7077"


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(_Cluster)
