"""Compare registered queries with their SQL counterparts: ``python tests/oracle.py [sf] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TESTDATA = "/root/testdata"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    engine = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        engine.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return engine


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(frame, statement: str, engine) -> list[str]:
    """What differs between a query and its SQL: columns, types, rows. Empty when nothing does."""
    result = engine.sql(statement)
    ours = {f.name: TYPES.get(f.dataType.simpleString(), "?") for f in frame.schema}
    theirs = {name: str(kind) for name, kind in zip(result.columns, result.types, strict=True)}
    found = []
    if ours != theirs:
        found.append(f"types: {sorted(set(ours.items()) ^ set(theirs.items()))}")
    if set(ours) != set(theirs):
        return found
    left = bag(frame.columns, frame.collect())
    right = bag(result.columns, result.fetchall())
    if left != right:
        found.append(
            f"rows: {sum(left.values())} / {sum(right.values())}, "
            f"only ours {list((left - right).items())[:2]}, "
            f"only SQL {list((right - left).items())[:2]}"
        )
    return found


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from fareloom.registry import entries
    from fareloom.session import session

    scale, *names = sys.argv[1:] or ["0.001"]
    folder = f"{TESTDATA}/sf{scale}"
    spark = session("oracle", "local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    engine = connect(folder)
    bad = 0
    for name, entry in entries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            frame = entry.build(spark, folder)
            if entry.sql:
                found = differences(frame, entry.sql, engine)
                verdict = "; ".join(found) or "equal"
            else:
                found, verdict = [], f"{len(frame.collect())} rows, no SQL"
        except Exception as error:  # report every query, then fail at the end
            found, verdict = [1], f"{type(error).__name__}: {str(error)[:400]}"
        bad += bool(found)
        print(f"{name:24} {time.time() - started:6.1f}s  {verdict}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
