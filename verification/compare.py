"""Run queries and their SQL side by side: ``python -m verification.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from tripmill.session import build_session
from verification.oracles import oracle_sql
from verification.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def spark_rows(df) -> Counter:
    names = sorted(df.columns)
    return Counter(tuple(row) for row in df.select(*names).collect())


def oracle_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = connection.sql(sql)
    order = sorted(range(len(result.columns)), key=lambda i: result.columns[i])
    rows = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    return [result.columns[i] for i in order], rows


_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def spark_types(df) -> dict[str, str]:
    return {name: _TYPES[kind] for name, kind in df.dtypes}


def oracle_types(connection: duckdb.DuckDBPyConnection, sql: str) -> dict[str, str]:
    result = connection.sql(sql)
    return dict(zip(result.columns, map(str, result.types)))


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session(
        "compare",
        "local[8]",
        {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
         "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, texts, bad = connect(sf_dir), oracle_sql(), 0
    for name in names or QUERIES:
        start = time.time()
        df = QUERIES[name](spark, sf_dir)
        got, (columns, wanted) = spark_rows(df), oracle_rows(connection, texts[name])
        same = got == wanted and columns == sorted(df.columns)
        bad += not same
        print(f"{name}: {sum(got.values())} rows, {'same' if same else 'DIFFERENT'}, "
              f"{time.time() - start:.1f} s", flush=True)
        if not same:
            print(" spark columns", sorted(df.columns), "\n sql columns", columns)
            print(" only in spark", list((got - wanted).items())[:2])
            print(" only in sql", list((wanted - got).items())[:2], flush=True)
        mine, theirs = spark_types(df), oracle_types(connection, texts[name])
        if mine != theirs:
            bad += same
            print(" types", {c: (mine[c], theirs.get(c)) for c in mine if mine[c] != theirs.get(c)})
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    raise SystemExit(main(args[0] if args else "/root/testdata/sf0.01", args[1:]))
