"""Run every query next to its SQL and compare the rows: ``python tests/check_oracle.py [sf] [names]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb

import __spark_entry__ as contract
from rankloom.session import spark_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return db


def difference(df, db, sql: str) -> str | None:
    """What differs between a DataFrame and a SQL result as bags of rows, or None."""
    frame = df.toPandas()
    got = frame[sorted(frame.columns)]
    cursor = db.execute(sql)
    names = [column[0] for column in cursor.description]
    rows = cursor.fetchall()
    if sorted(names) != list(got.columns):
        return f"columns {list(got.columns)} and {sorted(names)}"
    order = [names.index(name) for name in got.columns]

    def plain(value):
        if value is None or value != value:
            return None
        if isinstance(value, float):
            return round(value, 6)
        return value.item() if hasattr(value, "item") else value

    ours = sorted((tuple(plain(v) for v in row) for row in got.itertuples(index=False)), key=repr)
    theirs = sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows and {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} rows differ, such as {wrong[0]}" if wrong else None


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = spark_session("oracle", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled=False,
                          spark__driver__memory="12g", spark__ui__showConsoleProgress=False)
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    names = sys.argv[2:] or list(contract.queries())
    for name in names:
        start = time.time()
        try:
            df = contract.queries()[name](spark, sf_dir)
            seen = difference(df, db, contract.oracle_sql()[name])
            rows = df.count() if seen is None else "-"
        except Exception as error:
            seen, rows = f"{type(error).__name__}: {str(error)[:600]}", "-"
        print(f"{name:30s} {time.time() - start:6.1f}s {rows} {'ok' if seen is None else seen}", flush=True)


if __name__ == "__main__":
    main()
