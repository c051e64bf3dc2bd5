"""New synthetic rows drawn from fitted models."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.bindings import credit_wide
from creditloom.functions.scalars import steady_round
from creditloom.operators import checksums, copula
from creditloom.operators.sampling import class_quota
from creditloom.queries.registry import query
from creditloom.queries.sql import WIDE_NUMBERS, mean, with_ctes
from creditloom.session import materialise
from creditloom.vocabulary import TARGET

# Output rows per source row, and the seed.
_GROWTH = 5
_SEED = 42
# Bounds of the report besides the noise of a draw: means in standard deviations, rank correlations.
_MEAN_GAP, _RANK_GAP = 0.1, 0.15

_QUOTA = (
    f"SELECT {TARGET}, CAST(round_even(count(*)::DOUBLE / sum(count(*)) OVER () * {_GROWTH} * "
    f"(SELECT count(*) FROM customer), 0) AS BIGINT) AS rows FROM credit_wide GROUP BY {TARGET}"
)
_COLUMNS = [c for c in WIDE_NUMBERS if c != TARGET]


def _model(spark, sf):
    clients = materialise(credit_wide(spark, sf), "clients")
    quota = class_quota(clients, TARGET, _GROWTH * clients.count())
    wanted = {r[TARGET]: r["quota"] for r in quota.collect()}  # a row per class
    return clients, wanted, copula.fit(clients, TARGET, _COLUMNS)


@query(
    "copula_rows",
    with_ctes(
        f"SELECT m.*, q.rows, true AS in_range, true AS means_close, true AS ranks_close FROM ({_QUOTA}) q JOIN ("
        + " UNION ALL ".join(
            f"SELECT {TARGET}, '{c}' AS \"column\", {mean(c, 4)} AS source_mean FROM credit_wide GROUP BY {TARGET}"
            for c in _COLUMNS
        )
        + f") m ON m.{TARGET} = q.{TARGET}",
        "credit_wide",
    ).replace("SELECT m.*, q.rows", f"SELECT m.{TARGET}, m.\"column\", m.source_mean, q.rows"),
)
def copula_rows(spark, sf):
    """Five new rows per client, all 23 columns: quotas, ranges, means and rank correlations per class."""
    clients, quota, model = _model(spark, sf)
    drawn = materialise(copula.draw(spark, model, quota, _SEED), "drawn")
    found = copula.fidelity(clients, drawn, model)
    noise = 4 / F.sqrt("rows")
    means = clients.groupBy(TARGET).agg(*[steady_round(F.avg(c), 4).alias(c) for c in _COLUMNS])
    means = means.unpivot([TARGET], _COLUMNS, "column", "source_mean")
    return found.join(means, [TARGET, "column"]).select(
        TARGET,
        "column",
        "source_mean",
        "rows",
        "in_range",
        (F.col("mean_gap") <= _MEAN_GAP + noise).alias("means_close"),
        (F.col("rank_gap") <= _RANK_GAP + noise).alias("ranks_close"),
    )


@query(
    "copula_repeats",
    with_ctes(
        f"SELECT {TARGET}, rows, rows AS draws, CAST(0 AS BIGINT) AS other_rows, true AS seed_matters, "
        f"CAST(0 AS BIGINT) AS source_rows FROM ({_QUOTA})",
        "credit_wide",
    ),
)
def copula_repeats(spark, sf):
    """A stored model draws the same rows again, another seed draws others, and none is a row of the source."""
    clients, quota, model = _model(spark, sf)
    stored = copula.Copula.from_frame(materialise(model.to_frame(spark), "model"))
    # Two hashes stand for the cells where rows are brought together: 128 bits tell rows apart at any size.
    cells = [F.col(c) for c in _COLUMNS]
    marks = [checksums.row_hash(cells, F.lit(salt)) for salt in (1, 2)]
    draws = [
        copula.draw(spark, m, quota, seed).select("draw", TARGET, *[h.alias(f"{name}{i}") for i, h in enumerate(marks)])
        for name, m, seed in (("a", model, _SEED), ("b", stored, _SEED), ("c", model, _SEED + 1))
    ]
    joined = draws[0].join(draws[1], ["draw", TARGET]).join(draws[2], ["draw", TARGET])
    source = clients.select(F.col(TARGET).alias("label"), *[h.alias(f"s{i}") for i, h in enumerate(marks)]).distinct()
    same = (F.col(TARGET) == F.col("label")) & (F.col("a0") == F.col("s0")) & (F.col("a1") == F.col("s1"))
    # Hashes take more room than the packed file they are planned from, so the source is never broadcast.
    return (
        joined.join(source.hint("merge"), same, "left")
        .groupBy(TARGET)
        .agg(
            F.count("*").alias("rows"),
            F.count_distinct("draw").alias("draws"),
            F.count_if((F.col("a0") != F.col("b0")) | (F.col("a1") != F.col("b1"))).alias("other_rows"),
            # one hash that differs proves it
            (F.count_if(F.col("a0") != F.col("c0")) > 0).alias("seed_matters"),
            F.count("label").alias("source_rows"),
        )
    )
