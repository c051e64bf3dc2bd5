"""Headline timings. Prints one JSON line.

    BENCH_SF_DIR  folder of the parquet tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)

Three parts: the pipelines end to end (stage, load, analytic queries on the loaded tables, path B, KPI
tables), registered queries straight from the given tables, and the pipelines again over one wide row
per order, which at scale 0.1 is the size of the published runs: first in this session, then once more
with compiled code. ``ratio`` is that second run against the published seconds. Every result is written
to a sink that discards it, so all rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import time

from creditloom.bindings import ANCHOR_YEAR, credit_per_order, credit_wide, macro_long
from creditloom.plans import kpi as K
from creditloom.plans import mart as M
from creditloom.queries.catalogue import QUERIES
from creditloom.session import drop_scratch, local_session, scratch_path

REGISTERED = [
    "dedup_pk",
    "iqr_fences",
    "iqr_cap",
    "zscore_outliers",
    "column_profile",
    "unpivot_stack",
    "macro_pivot_case",
    "default_vs_macro",
    "corr_joined",
    "demographic_cube",
    "kpi_demographic_union",
    "kpi_demographic_onepass",
    "path_parity",
    "event_trends",
    "event_trends_sliced",
    "rank_in_period",
    "rank_in_period_scaled",
    "metrics_latest",
    "lines_per_source",
    "dq_single_pass",
    "dq_report",
    "scan_csv_roundtrip",
    "scan_json_observations",
    "bus_envelope",
    "stream_demux_credit",
    "stream_fanout_parity",
    "stratified_resample",
]


PUBLISHED = {
    "etl_transform": 63.73,
    "etl_load_and_queries": 18.71,
    "q1_overall": 1.10,
    "q2_sex": 0.62,
    "q3_education": 0.31,
    "q4_marriage": 0.22,
    "q5_age_band": 0.23,
    "q6_behaviour": 0.97,
    "q7_rate_vs_macro": 0.74,
    "q8_corr": 0.52,
    "elt_extract_load": 9.40,
    "elt_transform": 13.17,
    "kpi_build": 10.72,
}


def discard(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def pipeline_steps(spark, sf_dir: str, wide=credit_wide):
    staged = scratch_path(spark, "staged")
    a, b = "bench_a", "bench_b"

    def t(name, database=a):
        return spark.table(f"{database}.{name}")

    def credit():
        return wide(spark, sf_dir)

    def macro():
        return macro_long(spark, sf_dir)

    def kpis_a():
        fact, dates = t("fact_credit_monthly"), t("dim_date")
        K.save_kpis(spark, a, K.kpi_tables_a(t("dim_client"), fact, dates))

    def kpis_b():
        labelled = M.demographics(t("raw_credit", b))
        fact, months = t("elt_fact_monthly", b), t("elt_macro_monthly", b)
        K.save_kpis(spark, b, K.kpi_tables_b(labelled, fact, months))

    return {
        "etl_transform": lambda: M.stage_mart(credit(), macro(), ANCHOR_YEAR, staged),
        "etl_load": lambda: M.load_mart(spark, staged, a, scratch_path(spark, a)),
        "q1_overall": lambda: discard(K.overall(t("dim_client"))),
        "q2_sex": lambda: discard(K.rate_per_label(t("dim_client"), "sex_label")),
        "q3_education": lambda: discard(K.rate_per_label(t("dim_client"), "education_label")),
        "q4_marriage": lambda: discard(K.rate_per_label(t("dim_client"), "marriage_label")),
        "q5_age_band": lambda: discard(K.rate_per_label(t("dim_client"), "age_band")),
        "q6_behaviour": lambda: discard(K.behaviour(t("fact_credit_monthly"), t("dim_date"))),
        "q7_rate_vs_macro": lambda: discard(
            K.rate_vs_macro(t("fact_credit_monthly"), t("dim_date"))
        ),
        "q8_corr": lambda: discard(K.correlations(t("fact_credit_monthly"))),
        "elt_extract_load": lambda: M.land_raw(credit(), macro(), b, scratch_path(spark, b)),
        "elt_transform": lambda: M.build_elt(spark, b, ANCHOR_YEAR),
        "kpi_build_a": kpis_a,
        "kpi_build_b": kpis_b,
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, run):
        begin = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - begin, 3)

    for name, run in pipeline_steps(spark, sf_dir).items():
        timed(name, run)
    for name in REGISTERED:
        timed(name, lambda: discard(QUERIES[name](spark, sf_dir)))

    for run in ("cold", "warm"):
        for name, step in pipeline_steps(spark, sf_dir, credit_per_order).items():
            timed(f"{name}_per_order_{run}", step)
    warm = {n.removesuffix("_per_order_warm"): s for n, s in seconds.items() if n.endswith("_warm")}
    warm["etl_load_and_queries"] = sum(s for n, s in warm.items() if n[0] == "q") + warm["etl_load"]
    warm["kpi_build"] = warm["kpi_build_a"] + warm["kpi_build_b"]
    ratio = {n: round(warm[n] / published, 2) for n, published in PUBLISHED.items()}
    wide_rows = credit_per_order(spark, sf_dir).count()
    drop_scratch(spark)

    print(
        json.dumps(
            {
                "metric": "total_wall_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "wide_rows_per_order": wide_rows,
                "ratio": ratio,
            }
        )
    )


if __name__ == "__main__":
    main()
