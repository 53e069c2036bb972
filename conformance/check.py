"""Compare every registered query with its SQL answer: ``python -m conformance.check <dir> [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from .oracle import statements
from .queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def local_session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("isobar")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _sorted_rows(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if equal, else the first difference."""
    mine, my_rows = _sorted_rows(df.columns, df.collect())
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    theirs, their_rows = _sorted_rows(names, result.fetchall())
    if mine != theirs:
        return f"columns {sorted(set(mine) ^ set(theirs))}"
    if len(my_rows) != len(their_rows):
        return f"rows {len(my_rows)} != {len(their_rows)}"
    different = [(a, b) for a, b in zip(my_rows, their_rows) if a != b or repr(a) != repr(b)]
    if not different:
        return None
    a, b = different[0]
    cells = [(n, x, y) for n, x, y in zip(mine, a, b) if x != y or repr(x) != repr(y)]
    return f"{len(different)} of {len(my_rows)} rows differ, first {cells[:4]}"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con, answers = local_session(), connect(sf_dir), statements()
    failed = 0
    for name in sys.argv[2:] or QUERIES:
        started = time.monotonic()
        try:
            df = QUERIES[name](spark, sf_dir)
            problem = compare(df, con, answers[name]) if name in answers else None
            state = "ok" if problem is None else problem
        except Exception as error:  # one broken query must not hide the others
            state = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        failed += state != "ok"
        print(f"{time.monotonic() - started:7.2f}s  {name:36s} {state}", flush=True)
    print(f"{failed} failed; without SQL: {sorted(set(QUERIES) - set(answers))}; unused SQL: {sorted(set(answers) - set(QUERIES))}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
