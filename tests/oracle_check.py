"""Runs registered queries and their SQL side by side and compares schema, row count and values."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# Type families that both engines name differently.
FAMILIES = {
    "string": "text", "VARCHAR": "text",
    "bigint": "bigint", "BIGINT": "bigint",
    "int": "int", "INTEGER": "int",
    "double": "double", "DOUBLE": "double",
    "boolean": "boolean", "BOOLEAN": "boolean",
    "timestamp_ntz": "timestamp", "TIMESTAMP": "timestamp",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def compare(df, con, statement: str) -> str | None:
    """None when equal, else what differs."""
    ours = {name: FAMILIES.get(kind, kind) for name, kind in df.dtypes}
    rows = [tuple(row) for row in df.collect()]
    result = con.execute(statement)
    theirs = {column[0]: FAMILIES.get(str(column[1]), str(column[1])) for column in result.description}
    if sorted(ours) != sorted(theirs):
        return f"columns {sorted(ours)} != {sorted(theirs)}"
    kinds = {n: (ours[n], theirs[n]) for n in ours if ours[n] != theirs[n]}
    expected = result.fetchall()
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)}"
    names = sorted(ours)
    left = sorted([tuple(_cell(row[df.columns.index(n)]) for n in names) for row in rows])
    order = list(theirs)
    right = sorted([tuple(_cell(row[order.index(n)]) for n in names) for row in expected])
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(left)} rows differ, first {names}: {wrong[0]}"
    if kinds:
        return f"types differ: {kinds}"
    return None


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as registry
    from latewatch.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = set(sys.argv[2:])
    spark = build_session("oracle-check", "local[8]", 8, **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, statements, bad = connect(sf_dir), registry.oracle_sql(), 0
    for name, run in registry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.perf_counter()
        try:
            if name in statements:
                problem = compare(run(spark, sf_dir), con, statements[name])
            else:
                problem = None if run(spark, sf_dir).count() > 0 else "no rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:26s} {time.perf_counter() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
