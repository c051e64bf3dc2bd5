"""Compare registered queries with their SQL on the same parquet files.

    python tests/oracle_check.py [scale folder] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.12g}") + 0.0
    return value


def _key(row):
    return tuple((v is not None, str(type(v)), v) for v in row)


def _kinds(schema) -> dict[str, str]:
    same = {"large_string": "string"}
    return {f.name: same.get(str(f.type), str(f.type)) for f in schema}


def compare(df, con, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    ours = df.toArrow()
    theirs = con.sql(sql).to_arrow_table()
    names = sorted(ours.column_names)
    if names != sorted(theirs.column_names):
        return f"columns {names} != {sorted(theirs.column_names)}"
    kinds = _kinds(ours.schema), _kinds(theirs.schema)
    off = {n: (kinds[0][n], kinds[1][n]) for n in names if kinds[0][n] != kinds[1][n]}
    off = {n: k for n, k in off.items() if not all(x.startswith("timestamp") for x in k)}
    rows = []
    for t in (ours, theirs):
        cols = [[_plain(v) for v in t.column(n).to_pylist()] for n in names]
        rows.append(sorted(zip(*cols), key=_key))
    if len(rows[0]) != len(rows[1]):
        return f"{len(rows[0])} rows != {len(rows[1])} rows"
    for a, b in zip(*rows):
        if a != b:
            return f"{dict(zip(names, a))} != {dict(zip(names, b))}"
    return f"types {off}" if off else None


def main() -> int:
    from creditloom.session import local_session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle = entry.oracle_sql()
    failed = 0
    for name, run in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        begin = time.perf_counter()
        try:
            df = run(spark, sf_dir)
            if name in oracle:
                verdict = compare(df, con, oracle[name])
            else:
                verdict = None if df.count() > 0 else "no rows"
        except Exception as error:  # report and go on
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        took = time.perf_counter() - begin
        kind = "oracle" if name in oracle else "rows"
        print(f"{'ok  ' if verdict is None else 'FAIL'} {name:28} {kind} {took:6.2f}s {verdict or ''}", flush=True)
        failed += verdict is not None
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
