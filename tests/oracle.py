"""Side-by-side check of registered queries against their SQL in an in-process DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def plain(value: object) -> object:
    if isinstance(value, decimal.Decimal):
        return ("dec", str(value))
    if isinstance(value, bool) or value is None or isinstance(value, (int, str)):
        return value
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    raise TypeError(f"compare {type(value)} as text instead")


def compare(df, sql: str, con) -> str | None:
    """None when equal, else a short description of the difference."""
    columns = sorted(df.columns)
    ours = Counter(tuple(plain(row[c]) for c in columns) for row in df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}"
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(plain(row[i]) for i in order) for row in result.fetchall())
    if ours == theirs:
        return None
    return (
        f"rows {sum(ours.values())} against {sum(theirs.values())}; only spark: "
        f"{[tuple(str(v)[:60] for v in r) for r in list(ours - theirs)[:3]]}; only sql: "
        f"{[tuple(str(v)[:60] for v in r) for r in list(theirs - ours)[:3]]} {columns}"
    )


def main(folder: str, wanted: list[str]) -> int:
    from broadsheet.plans.catalog import ORACLES, QUERIES
    from broadsheet.session import build_session

    spark = build_session(
        master="local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name, run in QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in ORACLES:
                problem = compare(df, ORACLES[name], con)
            else:
                problem = None if df.count() else "no rows"
        except Exception as exc:  # noqa: BLE001
            problem = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.2f}s {'' if name in ORACLES else '(rows only) '}{problem or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
