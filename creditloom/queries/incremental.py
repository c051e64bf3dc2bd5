"""Results over arriving batches, from stored states; each must equal the rebuild over all rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.bindings import ANCHOR_YEAR, table
from creditloom.operators import aggregates as A
from creditloom.operators import states as S
from creditloom.operators.joins import dimension_join
from creditloom.plans import kpi as K
from creditloom.queries.marts import LABELS, clients_b, fact_b, landed_macro
from creditloom.queries.registry import ORACLE, query
from creditloom.queries.sql import with_ctes
from creditloom.session import materialise, scratch_path
from creditloom.vocabulary import DIMENSIONS, HISTORY, TARGET

MONTHS = [ANCHOR_YEAR * 100 + m for m in HISTORY]


def _by_month(spark, sf):
    """The monthly fact on disk, a folder per month, so that a batch reads its own month only."""
    return materialise(fact_b(spark, sf), "elt_fact", partition_by=["date_key"])


@query("corr_incremental", ORACLE["corr_joined"])
def corr_incremental(spark, sf):
    """Correlations after the months have come in one by one, the last one twice."""
    fact, macro, folder = _by_month(spark, sf), landed_macro(spark, sf), scratch_path(spark, "moments")
    names = {(TARGET, c): n for n, c in K.CORRELATIONS.items()}
    names |= {("bill_amt", c): n.replace("corr_", "bill_") for n, c in K.CORRELATIONS.items()}
    for month in [*MONTHS, MONTHS[-1]]:
        rows = dimension_join(fact.filter(F.col("date_key") == month), macro, ["date_key"], "inner")
        S.save_batch(S.moment_state(rows, list(names)), folder, month)
    return S.correlations_of(S.saved(spark, folder), names)


@query("kpi_demographic_incremental", with_ctes("SELECT * FROM cells_b", "cells_b"))
def kpi_demographic_incremental(spark, sf):
    """Rates per category after three deliveries of clients."""
    clients, folder = materialise(clients_b(spark, sf), "clients"), scratch_path(spark, "cells")
    for batch in range(3):
        S.save_batch(A.label_counts(clients.filter(F.col("id") % 3 == batch), LABELS), folder, batch)
    cells = S.merged_counts(S.saved(spark, folder), LABELS, ["clients", "rated", "hits"])
    return A.long_of_cube(A.cube_of_cells(cells, LABELS), DIMENSIONS)


_FENCED = ["limit_bal", "bill_amt", "pay_amt"]


@query(
    "fences_incremental",
    with_ctes(
        " UNION ALL ".join(
            f"SELECT '{c}' AS name, count({c}) AS rows, true AS q1_close, true AS q3_close FROM elt_fact"
            for c in _FENCED
        ),
        "elt_fact",
    ),
)
def fences_incremental(spark, sf):
    """Quartiles from a stored sketch per month, and whether their true ranks are within the stated error."""
    fact, folder = _by_month(spark, sf), scratch_path(spark, "sketches")
    for month in MONTHS:
        S.save_batch(S.sketch_state(fact.filter(F.col("date_key") == month), _FENCED), folder, month)
    fences = materialise(S.merged_fences(S.saved(spark, folder)), "fences")
    at = {q: fences.groupBy().pivot("name", _FENCED).agg(F.first(q)) for q in ("q1", "q3")}
    parts = []
    for c in _FENCED:
        for q, p in (("q1", 0.25), ("q3", 0.75)):
            value = at[q].select(c).scalar()
            n = F.count(c)
            below, upto = F.count_if(F.col(c) < value) / n, F.count_if(F.col(c) <= value) / n
            parts.append(((below <= p + S.RANK_ERROR) & (upto >= p - S.RANK_ERROR)).alias(f"{c}_{q}"))
    ranks = fact.agg(*parts)
    checked = F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(f"{c}_q1").alias("q1_close"), F.col(f"{c}_q3").alias("q3_close")) for c in _FENCED]
    )
    return fences.select("name", "rows").join(ranks.select(F.inline(checked)), "name")


_DELIVERED = (
    "(SELECT l_orderkey, l_linenumber, l_suppkey % 4 AS batch FROM lineitem UNION ALL "
    "SELECT l_orderkey, l_linenumber, 4 FROM lineitem WHERE l_orderkey % 5 = 0)"
)


@query(
    "dedup_incremental",
    "SELECT count(*) AS rows_before, count(DISTINCT l_orderkey * 100 + l_linenumber) AS rows_after, "
    "count(*) - count(DISTINCT l_orderkey * 100 + l_linenumber) AS removed, "
    "(SELECT count(DISTINCT l_orderkey * 100 + l_linenumber) FROM lineitem WHERE l_orderkey % 5 = 0) AS known, CAST(0 AS BIGINT) AS fresh "
    f"FROM {_DELIVERED}",
)
def dedup_incremental(spark, sf):
    """Duplicates on (order, line) over five deliveries, the last one all of known keys; one bitmap per 32,768 orders."""
    lines, folder = table(spark, sf, "lineitem"), scratch_path(spark, "keys")
    batches = [lines.filter(F.col("l_suppkey") % 4 == b) for b in range(4)]
    batches.append(lines.filter(F.col("l_orderkey") % 5 == 0))
    for number, batch in enumerate(batches):
        state = materialise(S.key_state(batch, "l_orderkey", ["l_linenumber"]), "key-state")
        if number == len(batches) - 1:
            known = materialise(S.repeated_keys(S.saved(spark, folder), state, ["l_linenumber"]), "known")
        S.save_batch(state, folder, number)
    return S.key_counts(S.saved(spark, folder), ["l_linenumber"]).select(
        "*", *[known.select(c).scalar().alias(c) for c in ("known", "fresh")]
    )
