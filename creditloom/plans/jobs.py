"""The pipelines as jobs: both paths end to end, KPI tables, export and comparison.

    python -m creditloom.plans.jobs all --credit raw/clients.csv --macro raw --year 2005 \
        --work /shared/risk

A job logs one metric row per stage, and path A answers with the verdict of the quality rules.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from creditloom.functions.names import snake_case
from creditloom.operators import observe, quality
from creditloom.operators.windows import latest
from creditloom.plans import kpi, mart
from creditloom.session import drop_scratch
from creditloom.sinks import tables
from creditloom.sources import files
from creditloom.vocabulary import CAPPED_COLUMNS, KPI_TABLES, SERIES_COLUMNS


@dataclass
class Job:
    """Where a run reads from and writes to. ``credit`` lists candidates, the first present wins."""

    credit: list[str]
    macro: str
    year: int
    work: str
    database_a: str = "risk_etl"
    database_b: str = "risk_elt"

    @property
    def log(self) -> str:
        return f"{self.work}/metrics"


def credit_type(name: str) -> str:
    """Type of a credit column by its name, whatever its spelling."""
    canonical = snake_case(name)
    if canonical == "id":
        return "bigint"
    return "double" if canonical in CAPPED_COLUMNS else "int"


def sources(spark: SparkSession, job: Job) -> tuple[DataFrame, DataFrame]:
    credit = files.read_credit(spark, job.credit, credit_type)
    observations = files.read_series_files(
        spark,
        lambda series: f"{job.macro}/fred_{series}_{job.year}.json",
        SERIES_COLUMNS,
        rf"fred_([A-Z0-9]+)_{job.year}",
        multi_line=True,  # a download of one series and year: a small document over many lines
    )
    return credit, observations


def lost(spark: SparkSession, job: Job) -> DataFrame:
    """(column, lost): values of the credit source that its types cannot hold."""
    return files.lost_values(files.read_credit_text(spark, job.credit), credit_type)


def run_path_a(spark: SparkSession, job: Job, error: float | None = None) -> bool:
    """Stage and check; if every rule passes, publish the star schema and its KPI tables in one step.

    A failing rule or a load that dies leaves readers what they had; the report is written either way.
    """
    credit, observations = sources(spark, job)
    staging = f"{job.work}/staging"
    with observe.StageRun(spark, job.log, "ETL", "transform") as stage:
        mart.stage_mart(credit, observations, job.year, staging, error=error)
        staged = {name: spark.read.parquet(f"{staging}/{name}") for name in mart.TABLES}
        fact, clients = staged["fact_credit_monthly"], staged["dim_client"]
        rules = quality.rule_report(fact, clients, staged["dim_date"])
        report = rules.unionByName(quality.source_rule(lost(spark, job)))
        tables.write_report(report, f"{job.work}/validation_report")
        stage.count_rows(fact)
    written = spark.read.schema(report.schema).json(f"{job.work}/validation_report")
    if not quality.gate(written).first().all_pass:
        return False
    with observe.StageRun(spark, job.log, "ETL", "load") as stage:
        kpis = kpi.kpi_tables_a(clients, fact, staged["dim_date"])
        mart.publish_mart(spark, staging, job.database_a, f"{job.work}/{job.database_a}", kpis)
        stage.count_rows(spark.table(f"{job.database_a}.fact_credit_monthly"))
    return True


def run_path_b(spark: SparkSession, job: Job) -> None:
    """Land both sources with a record of what landed, build the analytic and the KPI tables."""
    credit, observations = sources(spark, job)
    name = job.database_b
    with observe.StageRun(spark, job.log, "ELT", "extract_load") as stage:
        mart.land_raw(credit, observations, name, f"{job.work}/{name}")
        landed = [observe.landing_metadata(spark.table(f"{name}.{t}"), t) for t in ("raw_credit", "raw_macro")]
        record = landed[0].unionByName(landed[1])
        tables.write_report(record, f"{job.work}/load_metadata")
        tables.write_report(lost(spark, job).filter("lost > 0"), f"{job.work}/lost_values")
        stage.rows = spark.read.schema(record.schema).json(f"{job.work}/load_metadata").agg({"rows": "sum"}).first()[0]
    with observe.StageRun(spark, job.log, "ELT", "transform") as stage:
        mart.build_elt(spark, name, job.year)
        built = {t: spark.table(f"{name}.{t}") for t in mart.ELT_TABLES}
        fact, months = built["elt_fact_monthly"], built["elt_macro_monthly"]
        labelled = mart.demographics(spark.table(f"{name}.raw_credit"))
        kpi.save_kpis(spark, name, kpi.kpi_tables_b(labelled, fact, months))
        stage.rows = files.count_tables(built).agg({"n_rows": "sum"}).first()[0]


def export(spark: SparkSession, job: Job) -> bool:
    """CSV of every KPI table of both databases, and a record of each; whether none was skipped."""
    databases, record = [job.database_a, job.database_b], f"{job.work}/export_record"
    written = tables.export_tables(spark, databases, KPI_TABLES, f"{job.work}/exports", record)
    return len(written) == len(databases) * len(KPI_TABLES)


def compare(spark: SparkSession, job: Job) -> DataFrame:
    """Latest metric per stage and totals per path, both also as CSV."""
    log = observe.read_metrics(spark, job.log).drop("extra")
    newest = latest(log, ["pipeline", "stage"], ["ts"])
    tables.write_csv(observe.metrics_table(newest), f"{job.work}/comparison/stages")
    totals = observe.path_summary(newest, ["ETL", "ELT"])
    tables.write_csv(totals, f"{job.work}/comparison/totals")
    return totals


def main() -> int:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("step", choices=["a", "b", "export", "compare", "all"])
    parser.add_argument("--credit", nargs="+", required=True)
    parser.add_argument("--macro", required=True)
    parser.add_argument("--year", type=int, required=True)
    parser.add_argument("--work", required=True)
    parser.add_argument("--error", type=float, help="rank error allowed for the outlier fences")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("creditloom").getOrCreate()
    job = Job(args.credit, args.macro, args.year, args.work)
    passed = True
    try:
        if args.step in ("a", "all"):
            passed = run_path_a(spark, job, args.error)
        if args.step in ("b", "all"):
            run_path_b(spark, job)
        if passed and args.step in ("export", "all"):
            passed = export(spark, job)
        if args.step in ("compare", "all"):
            compare(spark, job).show()
    finally:
        drop_scratch(spark)
    return 0 if passed else 1


if __name__ == "__main__":
    raise SystemExit(main())
