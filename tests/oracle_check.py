"""Run queries next to their DuckDB SQL and report differences.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return str(value.replace(tzinfo=None))
    return str(value)


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same columns and rows, else what differs first."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    found = _rows(df.columns, df.collect())
    if len(found) != len(expected):
        extra, missing = set(found) - set(expected), set(expected) - set(found)
        return f"rows {len(found)} != {len(expected)}: +{list(extra)[:2]} -{list(missing)[:2]}"
    for ours, theirs in zip(found, expected):
        if ours != theirs:
            return f"{ours} != {theirs}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from runlens.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        began = time.time()
        try:
            df = query(spark, sf_dir)
            n = df.count()
            problem = differences(df, con, oracle[name]) if name in oracle else "no SQL"
        except Exception as error:  # noqa: BLE001
            n, problem = -1, f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} rows={n} {time.time() - began:.1f}s {problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
