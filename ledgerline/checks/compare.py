"""Run queries on Spark and their SQL on DuckDB and compare the results.

    python -m ledgerline.checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Columns by name, rows in order; floats by all their digits."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "~"
        if isinstance(v, float):
            return repr(v + 0.0)
        return str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both agree exactly, else a short description."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(set(spark_df.columns) ^ set(names))}"
    got = spark_df.collect()
    a, b = _canonical(spark_df.columns, got), _canonical(names, want)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}"
    bad = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, columns {sorted(names)}: {bad[0][0]} vs {bad[0][1]}"
    return None


def main() -> int:
    from ledgerline.checks import oracle, registry
    from ledgerline.session import local_session

    args = sys.argv[1:]
    sf_dir = args[0] if args and "/" in args[0] else "/root/testdata/sf0.01"
    only = [a for a in args if "/" not in a]
    spark, con = local_session(8), connect(sf_dir)
    expected, failed = oracle.oracle_sql(), 0
    for name, query in registry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in expected:
                problem = difference(query(spark, sf_dir), con, expected[name])
            else:
                problem = None if query(spark, sf_dir).count() else "no rows"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
