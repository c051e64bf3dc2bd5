"""Analytic queries over the mart, KPI tables of both paths, and the summary document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions import scalars as S
from creditloom.operators import aggregates as A
from creditloom.operators.joins import dimension_join
from creditloom.plans import mart as M
from creditloom.sinks import tables
from creditloom.vocabulary import (
    AGE_BANDS,
    DIMENSIONS,
    OPEN_AGE_BAND,
    SCALED_INDICATORS,
    TARGET,
    UNKNOWN,
)

BAND_ORDER = {label: i for i, label in enumerate([*dict(AGE_BANDS).values(), OPEN_AGE_BAND])}
LAST = 99

CORRELATIONS = {
    "corr_fx": "exchange_rate_twd_usd",
    "corr_reer": "real_broad_eer",
    "corr_reserves": "total_reserves",
}


def band_position(band: Column) -> Column:
    """Place of an age band in natural order; anything else comes last."""
    return F.coalesce(F.element_at(S.literal_map(BAND_ORDER), band), F.lit(LAST))


# --- the eight analytic queries ------------------------------------------------------------------


def overall(dim_client: DataFrame) -> DataFrame:
    return A.overall_rate(dim_client, "overall_default_rate")


def rate_per_label(dim_client: DataFrame, label: str) -> DataFrame:
    order = [F.col(label)] if label == "age_band" else [F.desc("default_rate"), F.col(label)]
    return A.rate_by(dim_client, label).orderBy(*order)


def _with_date(per_month: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Inner join of per-month rows onto the calendar; both sides are one row per month."""
    return per_month.join(dim_date.select("date_key", "month_name"), "date_key")


def behaviour(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    per_month = A.means_by(
        fact,
        ["date_key"],
        {
            "avg_credit_utilization": ("credit_utilization", 4),
            "avg_payment_ratio": ("payment_ratio", 4),
            "avg_bill_amt": ("bill_amt", 2),
        },
    )
    return (
        _with_date(per_month, dim_date)
        .select(
            "date_key", "month_name", "avg_credit_utilization", "avg_payment_ratio", "avg_bill_amt"
        )
        .orderBy("date_key")
    )


def rate_vs_macro(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    per_month = A.means_by(
        fact,
        ["date_key"],
        {
            "avg_fx_twd_usd": ("exchange_rate_twd_usd", 4),
            "avg_real_broad_eer": ("real_broad_eer", 4),
            "avg_total_reserves": ("total_reserves", 2),
            "default_rate": (TARGET, 4),
        },
    )
    return (
        _with_date(per_month, dim_date)
        .select(
            "date_key",
            "month_name",
            "avg_fx_twd_usd",
            "avg_real_broad_eer",
            "avg_total_reserves",
            "default_rate",
        )
        .orderBy("date_key")
    )


def correlations(fact: DataFrame, against: str = TARGET, prefix: str = "corr_") -> DataFrame:
    return fact.agg(
        *[
            A.correlation(against, c).alias(name.replace("corr_", prefix))
            for name, c in CORRELATIONS.items()
        ]
    )


# --- KPI tables -----------------------------------------------------------------------------------


def monthly_a(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    per_month = A.means_by(
        fact,
        ["date_key"],
        {
            "default_rate": (TARGET, 4),
            "exchange_rate_twd_usd": ("exchange_rate_twd_usd", 4),
            "real_broad_eer": ("real_broad_eer", 4),
            "total_reserves": ("total_reserves", 2),
        },
    )
    return (
        _with_date(per_month, dim_date)
        .select("date_key", "month_name", "default_rate", *SCALED_INDICATORS)
        .orderBy("date_key")
    )


def monthly_b(vs_macro: DataFrame) -> DataFrame:
    return vs_macro.select(
        "date_key",
        S.month_name_of_key(F.col("date_key")).alias("month_name"),
        "default_rate",
        *SCALED_INDICATORS,
    ).orderBy("date_key")


def kpi_tables_a(dim_client: DataFrame, fact: DataFrame, dim_date: DataFrame) -> dict:
    cube = A.rate_cube(dim_client, list(DIMENSIONS.values()))
    return {
        "kpi_overall": A.overall_rate(dim_client, "default_rate"),
        "kpi_default_by_demographic": A.long_of_cube(cube, DIMENSIONS),
        "kpi_monthly_default_vs_macro": monthly_a(fact, dim_date),
        "kpi_corr_default_macro": correlations(fact),
    }


def kpi_tables_b(labelled: DataFrame, fact: DataFrame, macro: DataFrame) -> dict:
    labels = list(DIMENSIONS.values())
    cube = A.rate_cube(labelled, labels)
    return {
        "kpi_overall": A.total_of_cube(cube, labels),
        "kpi_default_by_demographic": A.long_of_cube(cube, DIMENSIONS),
        "kpi_monthly_default_vs_macro": monthly_b(M.elt_default_vs_macro(fact, macro)),
        "kpi_corr_default_macro": correlations(dimension_join(fact, macro, ["date_key"], "inner")),
    }


def save_kpis(spark: SparkSession, database: str, kpis: dict[str, DataFrame]) -> None:
    for name, df in kpis.items():
        tables.save_table(df, f"{database}.{name}")


# --- readings of the KPI tables -------------------------------------------------------------------


def risk_extremes(by_category: DataFrame) -> DataFrame:
    """(kind, dimension, category, default_rate) of the riskiest and the safest known group."""
    known = by_category.filter(F.col("category") != UNKNOWN)
    group = F.struct("dimension", "category", "default_rate")
    # Ties go to the smaller name on both ends, so one result is possible only.
    highest = F.min_by(group, F.struct(-F.col("default_rate"), F.col("dimension"), F.col("category")))
    lowest = F.min_by(group, F.struct(F.col("default_rate"), F.col("dimension"), F.col("category")))
    both = known.agg(highest.alias("high"), lowest.alias("low"))
    return both.select(
        F.inline(
            F.array(
                F.struct(F.lit("highest").alias("kind"), F.col("high").alias("g")),
                F.struct(F.lit("lowest").alias("kind"), F.col("low").alias("g")),
            )
        )
    ).select("kind", "g.*")


def versus_overall(by_category: DataFrame, overall_kpi: DataFrame) -> DataFrame:
    """Distance of each category from the overall rate in percentage points."""
    base = overall_kpi.select("default_rate").scalar()
    points = F.round((F.col("default_rate") - base) * 100, 2)
    return by_category.select(
        "dimension",
        "category",
        "clients",
        "default_rate",
        (points + 0.0).alias("diff_pp"),
        (F.col("default_rate") >= base).alias("at_or_above"),
    )


def default_split(overall_kpi: DataFrame) -> DataFrame:
    return overall_kpi.select(
        "total_clients",
        "default_rate",
        F.round(F.col("total_clients") * F.col("default_rate")).alias("defaulting"),
        F.round(F.col("total_clients") * (1 - F.col("default_rate"))).alias("non_defaulting"),
        F.round(1 - F.col("default_rate"), 4).alias("complement_rate"),
    )


def dimension_totals(by_category: DataFrame) -> DataFrame:
    return by_category.groupBy("dimension").agg(
        F.sum("clients").alias("clients"), F.count("*").alias("categories")
    )


def reference_line(monthly_kpi: DataFrame) -> DataFrame:
    """Unweighted mean of the monthly rates."""
    return monthly_kpi.agg(S.steady_round(F.avg("default_rate"), 6).alias("mean_rate"))


def ordered_categories(by_category: DataFrame) -> DataFrame:
    """Categories with their display position: bands in natural order, the rest by falling rate."""
    natural = F.col("dimension") == "age_band"
    return by_category.withColumn(
        "position",
        F.when(natural, band_position(F.col("category")).cast("double")).otherwise(
            -F.col("default_rate")
        ),
    )


def summary(by_category: DataFrame) -> DataFrame:
    """One row per dimension with its categories as an ordered list."""
    return A.nested_by(
        ordered_categories(by_category),
        "dimension",
        F.struct("position", "category"),
        ["category", "clients", "default_rate"],
    )


def summary_document(
    overall_kpi: DataFrame, corr: DataFrame, by_category: DataFrame, months: DataFrame
) -> DataFrame:
    """The whole KPI summary of one path as a single JSON text; every part is KPI-sized."""
    demo = summary(by_category).agg(
        F.map_from_entries(F.collect_list(F.struct("dimension", "items"))).alias("v")
    )
    entry = F.struct(*months.columns)
    series = months.agg(F.sort_array(F.collect_list(entry)).alias("v"))
    head = overall_kpi.select(F.struct(*overall_kpi.columns).alias("v"))
    corrs = corr.select(F.struct(*corr.columns).alias("v"))
    document = F.struct(
        head.scalar().alias("overall"),
        corrs.scalar().alias("corr"),
        demo.scalar().alias("demo"),
        series.scalar().alias("monthly"),
    )
    return overall_kpi.sparkSession.range(1).select(F.to_json(document).alias("document"))


def parity(a: DataFrame, b: DataFrame, keys: list[str], tolerance: dict[str, float]) -> DataFrame:
    """Full outer comparison of two KPI tables: both values and whether each is within tolerance."""
    left = a.select(*keys, *[F.col(c).alias(f"{c}_a") for c in tolerance])
    right = b.select(*keys, *[F.col(c).alias(f"{c}_b") for c in tolerance])
    joined = left.join(right, keys, "full_outer")
    agree = F.lit(True)
    for c, limit in tolerance.items():
        agree = agree & F.coalesce(
            F.abs(F.col(f"{c}_a") - F.col(f"{c}_b")) <= limit,
            F.col(f"{c}_a").isNull() & F.col(f"{c}_b").isNull(),
        )
    return joined.withColumn("agrees", agree)
