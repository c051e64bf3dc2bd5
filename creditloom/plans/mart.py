"""The two ways to the mart.

Path A cleans first (duplicates, NULL, fences, age) and builds a star schema. Path B lands raw rows
and computes the analytic tables from them. Both are lazy; ``load_mart`` writes path A as tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions import scalars as S
from creditloom.functions.names import rename_all, warehouse_name
from creditloom.operators import cleaning as C
from creditloom.operators import reshape as R
from creditloom.operators.aggregates import rate, rate_cube
from creditloom.operators.joins import dimension_join
from creditloom.operators.windows import rank_in_group, running
from creditloom.session import materialise
from creditloom.sinks import publish, tables
from creditloom.vocabulary import (
    AGE_RANGE,
    BILL_COLUMNS,
    BILLING_MONTHS,
    CAPPED_COLUMNS,
    DIMENSIONS,
    EDUCATION_LABELS,
    HISTORY,
    INDICATORS,
    MARRIAGE_LABELS,
    PAYMENT_COLUMNS,
    SCALED_INDICATORS,
    SERIES_COLUMNS,
    SEX_LABELS,
    STATUS_COLUMNS,
    TARGET,
)

MEASURES = ["pay_status", "bill_amt", "pay_amt"]

# Declared schemas of the star tables (the constraints are checked as data, see quality).
DIM_CLIENT_SCHEMA = {
    "id": "bigint",
    "sex": "int",
    "sex_label": "string",
    "education": "int",
    "education_label": "string",
    "marriage": "int",
    "marriage_label": "string",
    "age": "int",
    "age_band": "string",
    TARGET: "int",
    "avg_delay_months": "double",
    "num_months_delayed": "int",
    "total_bill_amt": "double",
    "total_pay_amt": "double",
    "repayment_gap": "double",
}
DIM_DATE_SCHEMA = {
    "date_key": "int",
    "full_date": "date",
    "year": "int",
    "month": "int",
    "month_name": "string",
    "quarter": "int",
    "is_billing_month": "boolean",
}
FACT_SCHEMA = {
    "id": "bigint",
    "date_key": "int",
    "month": "int",
    "month_name": "string",
    "limit_bal": "double",
    "pay_status": "int",
    "bill_amt": "double",
    "pay_amt": "double",
    TARGET: "int",
    "credit_utilization": "double",
    "payment_ratio": "double",
    **{c: "double" for c in INDICATORS},
    **{f"{c}_norm": "double" for c in SCALED_INDICATORS},
}


# --- path A: clean, then model ---------------------------------------------------------------


def clean_credit(
    credit: DataFrame, cap: bool = True, error: float | None = None, ordered: bool = True
) -> DataFrame:
    """Cleaned client rows. Filling comes before the fences, so filled zeros move the quartiles.

    ``cap=False`` leaves the fences out for readers that use no amount. ``error`` allows sketch
    quantiles of that rank error. ``ordered`` fixes which duplicate survives, which two tables made of
    the result need to agree; a single reader may do without, and then unread columns are pruned.
    """
    unique = C.dedup_ordered(credit, ["id"]) if ordered else C.dedup(credit, ["id"])
    filled = C.fill_numeric(unique, 0, keep_null=("id",))
    if cap:
        # Fences need the filled rows before the rows can be capped: write them once, as the joins
        # and groups they come from are far larger than the client table they leave.
        filled = C.iqr_cap(materialise(filled, "filled"), CAPPED_COLUMNS, error=error)
    return C.clamp_column(filled, "age", *AGE_RANGE)


def demographics(credit: DataFrame) -> DataFrame:
    """Add the readable labels of the coded columns."""
    return credit.withColumns(
        {
            "sex_label": S.decode(F.col("sex"), SEX_LABELS),
            "education_label": S.decode(F.col("education"), EDUCATION_LABELS),
            "marriage_label": S.decode(F.col("marriage"), MARRIAGE_LABELS),
            "age_band": S.banded(F.col("age")),
        }
    )


def client_features(credit: DataFrame) -> DataFrame:
    """Add the behaviour features, over the history columns that are present."""

    def present(names):
        return [F.col(c) for c in names if c in credit.columns]

    status, bills, payments = map(present, (STATUS_COLUMNS, BILL_COLUMNS, PAYMENT_COLUMNS))
    billed, paid = S.total(bills), S.total(payments)
    return credit.withColumns(
        {
            "avg_delay_months": F.round(S.total(status) / len(status), 3),
            "num_months_delayed": S.count_positive(status),
            "total_bill_amt": billed,
            "total_pay_amt": paid,
            "repayment_gap": billed - paid,
        }
    )


def dim_client(clean: DataFrame) -> DataFrame:
    return client_features(demographics(clean)).select(*DIM_CLIENT_SCHEMA)


def dim_date(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Calendar of whole months from ``first`` to ``last`` (ISO dates, both included)."""
    bounds = spark.range(1).select(
        F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last")
    )
    return dim_date_between(bounds)


def dim_date_between(bounds: DataFrame) -> DataFrame:
    """The same from a one-row table (first, last), such as the extremes of a fact."""
    start, stop = F.trunc("first", "month"), F.trunc("last", "month")
    months = bounds.select(
        F.explode(F.sequence(start, stop, F.expr("interval 1 month"))).alias("full_date")
    )
    month = F.month("full_date")
    return months.select(
        S.month_key(F.col("full_date")).alias("date_key"),
        "full_date",
        F.year("full_date").alias("year"),
        month.alias("month"),
        S.month_name(month).alias("month_name"),
        F.quarter("full_date").alias("quarter"),
        month.between(*BILLING_MONTHS).alias("is_billing_month"),
    )


def calendar_year(spark: SparkSession, year: int) -> DataFrame:
    return dim_date(spark, f"{year}-01-01", f"{year}-12-01")


def dim_macro(observations: DataFrame, calendar: DataFrame) -> DataFrame:
    """Dense macro dimension: indicators, their z-scores, imputed and scaled values.

    Scores are taken before the mean fills a missing month (it keeps a NULL score). The mean never
    leaves the range, so the bounds for scaling are those of the observed values.
    """
    # The spine has one row per calendar month, so a window over all of it is small; a subquery
    # would go back to the observations for its statistics.
    spine = R.macro_spine(observations, calendar, SERIES_COLUMNS)
    def over(measure, c):
        return F.expr(f"{measure}({c}) OVER (PARTITION BY 1)")

    def filled(c):
        return F.coalesce(F.col(c), over("avg", c))

    return spine.select(
        "date_key",
        *[filled(c).alias(c) for c in INDICATORS],
        *[
            C.zscore_of(F.col(c), over("avg", c), over("stddev_samp", c)).alias(f"{c}_zscore")
            for c in INDICATORS
        ],
        *[
            C.minmax_of(filled(c), over("min", c), over("max", c)).alias(f"{c}_norm")
            for c in SCALED_INDICATORS
        ],
    )


def monthly(credit: DataFrame, year: int, zero: float | None) -> DataFrame:
    """Unpivoted history with the two ratios; ``zero`` stands for a ratio without denominator."""
    groups = {year * 100 + m: cols for m, cols in HISTORY.items()}
    long = R.unpivot_groups(credit, ["id", "limit_bal", TARGET], "date_key", MEASURES, groups)
    return long.withColumns(
        {
            "month": F.col("date_key") % 100,
            "credit_utilization": S.ratio(F.col("bill_amt"), F.col("limit_bal"), 4, zero),
            "payment_ratio": S.ratio(F.col("pay_amt"), F.col("bill_amt"), 4, zero),
        }
    )


def fact_monthly(clean: DataFrame, macro: DataFrame, year: int) -> DataFrame:
    """Monthly fact with the macro values of its month (the macro spine has twelve rows)."""
    fact = dimension_join(monthly(clean, year, zero=0.0), macro, ["date_key"], "left", bounded=True)
    ordered = ["id", "date_key", "month", "limit_bal", *MEASURES, TARGET]
    ordered += ["credit_utilization", "payment_ratio"]
    rest = [c for c in macro.columns if c != "date_key"]
    return fact.select(*ordered, *rest, S.month_name(F.col("month")).alias("month_name"))


@dataclass
class Mart:
    dim_client: DataFrame
    dim_date: DataFrame
    dim_macro: DataFrame
    fact: DataFrame


def mart_a(
    credit: DataFrame,
    observations: DataFrame,
    year: int,
    error: float | None = None,
    cap: bool = True,
    ordered: bool = True,
) -> Mart:
    calendar = calendar_year(credit.sparkSession, year)
    clean = clean_credit(credit, cap=cap, error=error, ordered=ordered)
    macro = dim_macro(observations, calendar)
    return Mart(dim_client(clean), calendar, macro, fact_monthly(clean, macro, year))


TABLES = ("dim_client", "dim_date", "dim_macro", "fact_credit_monthly")


def stage_mart(
    credit: DataFrame,
    observations: DataFrame,
    year: int,
    folder: str,
    error: float | None = None,
    ordered: bool = True,
) -> dict[str, str]:
    """Write the four path A tables. The filled clients are written once and read for the fences, the
    dimension and the fact, so these cannot disagree about a duplicate."""
    spark = credit.sparkSession
    calendar = calendar_year(spark, year)
    clean = clean_credit(credit, error=error, ordered=ordered)
    macro = materialise(dim_macro(observations, calendar), "macro")
    frames = {
        "dim_client": (dim_client(clean), None),
        "dim_date": (calendar, None),
        "dim_macro": (macro, None),
        "fact_credit_monthly": (fact_monthly(clean, macro, year), ["date_key"]),
    }
    for name, (df, by) in frames.items():
        tables.write_parquet(df, f"{folder}/{name}", by)
    return {name: f"{folder}/{name}" for name in frames}


def load_mart(spark: SparkSession, folder: str, database: str, location: str | None = None) -> None:
    """Load the staged tables into a freshly created database."""
    tables.rebuild_database(spark, database, location)
    for name in TABLES:
        by = ["date_key"] if name == "fact_credit_monthly" else None
        tables.save_table(spark.read.parquet(f"{folder}/{name}"), f"{database}.{name}", by)


def publish_mart(
    spark: SparkSession, folder: str, database: str, location: str, more: dict[str, DataFrame] | None = None
) -> int:
    """Publish the staged tables, and ``more`` made from them, in one step; readers never see half a mart."""
    publish.create_database(spark, database, location)
    frames: dict = {}
    for name in TABLES:
        by = ["date_key"] if name == "fact_credit_monthly" else []
        frames[name] = (spark.read.parquet(f"{folder}/{name}"), by)
    frames |= {name: (df, []) for name, df in (more or {}).items()}
    return publish.publish_tables(spark, database, frames)


# --- path B: land raw, model in SQL shape ------------------------------------------------------


def elt_fact(credit: DataFrame, year: int) -> DataFrame:
    """Raw rows unpivoted; duplicates, NULL and undefined ratios are kept."""
    return monthly(credit, year, zero=None).select(
        "id",
        "date_key",
        "limit_bal",
        *MEASURES,
        TARGET,
        "credit_utilization",
        "payment_ratio",
    )


def elt_macro(observations: DataFrame) -> DataFrame:
    return R.macro_by_month(observations, SERIES_COLUMNS)


def elt_trends(fact: DataFrame) -> DataFrame:
    """Per client: previous bill, change, running utilisation; per month: rank of the bill.

    A client that occurs twice has two rows per month; the remaining columns break such ties.
    """
    order = ["date_key", "bill_amt", "pay_amt", "pay_status", "limit_bal"]
    trends = running(fact, "id", order, "bill_amt", "credit_utilization")
    # groups and values are those of the fact, which is a table; the trends are read once
    ranked = rank_in_group(trends, "date_key", "bill_amt", "bill_rank_in_month", stored=fact)
    return ranked.select(
        "id",
        "date_key",
        "bill_amt",
        "pay_amt",
        "credit_utilization",
        F.col("previous").alias("prev_bill_amt"),
        F.col("change").alias("bill_mom_change"),
        F.col("running_avg").alias("run_avg_utilization"),
        "bill_rank_in_month",
    )


def elt_default_vs_macro(fact: DataFrame, macro: DataFrame) -> DataFrame:
    """Rate per month next to the macro values. The fact is aggregated to one row per month before
    the join, which carries the same values as joining first and taking their maximum."""
    per_month = fact.groupBy("date_key").agg(rate().alias("default_rate"))
    return per_month.join(macro, "date_key", "left").select(
        "date_key", "default_rate", *SCALED_INDICATORS
    )


ELT_TABLES = (
    "elt_macro_monthly",
    "elt_fact_monthly",
    "elt_client_trends",
    "elt_default_by_demographic",
    "elt_default_vs_macro",
)


def land_raw(
    credit: DataFrame, observations: DataFrame, database: str, location: str | None = None
) -> None:
    """Land both sources unchanged, with names the catalog accepts."""
    spark = credit.sparkSession
    tables.rebuild_database(spark, database, location)
    tables.save_table(rename_all(credit, warehouse_name), f"{database}.raw_credit")
    tables.save_table(observations, f"{database}.raw_macro")


def build_elt(spark: SparkSession, database: str, year: int) -> None:
    """The five analytic tables, each built from landed or already built tables."""

    def table(name: str) -> DataFrame:
        return spark.table(f"{database}.{name}")

    def save(name: str, df: DataFrame, by: list[str] | None = None) -> None:
        tables.save_table(df, f"{database}.{name}", by)

    save("elt_macro_monthly", elt_macro(table("raw_macro")))
    save("elt_fact_monthly", elt_fact(table("raw_credit"), year), ["date_key"])
    save("elt_client_trends", elt_trends(table("elt_fact_monthly")), ["date_key"])
    cube = rate_cube(demographics(table("raw_credit")), list(DIMENSIONS.values()))
    save("elt_default_by_demographic", cube)
    save(
        "elt_default_vs_macro",
        elt_default_vs_macro(table("elt_fact_monthly"), table("elt_macro_monthly")),
    )
