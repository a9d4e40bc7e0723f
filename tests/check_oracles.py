"""Compares every registered query with its SQL answer: ``python tests/check_oracles.py SF_DIR [name ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def normal(value):
    if value is None or value != value:
        return None
    if isinstance(value, Decimal):
        return round(float(value), 6)
    if isinstance(value, bool):
        return bool(value)
    if isinstance(value, float):
        return 0.0 if value == 0 else float(f"{value:.10g}")
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day).isoformat()
    if isinstance(value, int):
        return int(value)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


def compare(spark, con, query, sql, sf_dir):
    """(None or a difference, number of rows, seconds in Spark)."""
    began = time.time()
    df = query(spark, sf_dir)
    mine = [tuple(row) for row in df.collect()]
    seconds = time.time() - began
    if sql is None:
        return None, len(mine), seconds
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    theirs = answer.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}", len(mine), seconds
    left, right = table(df.columns, mine), table(names, theirs)
    if left != right:
        gone, extra = right - left, left - right
        names = sorted(names)
        a, b = min(gone, key=str, default=()), min(extra, key=str, default=())
        cells = [(n, x, y) for n, x, y in zip(names, a, b, strict=False) if x != y][:6]
        return f"rows {len(mine)}/{len(theirs)}, {sum(gone.values())} differ, e.g. {cells}", len(mine), seconds
    return None, len(mine), seconds


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def main() -> int:
    import __spark_entry__ as entry
    from ledgerlens.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]",
        extra={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, answers = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not wanted or any(n.startswith(x) for x in wanted)]
    bad = 0
    for name in names:
        try:
            problem, rows, seconds = compare(spark, con, queries[name], answers.get(name), sf_dir)
        except Exception as error:
            problem, rows, seconds = f"{type(error).__name__}: {str(error)[:700]}", -1, 0.0
        bad += problem is not None
        kind = "  " if name in answers else "no sql "
        print(f"{'BAD' if problem else 'ok '} {kind}{name} rows={rows} {seconds:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
