"""Run a registered query in Spark and its SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

SF_DIR = "/root/testdata/sf0.01"


def duckdb_over(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return round(value, 9)
    return value


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(_value(row[i]) for i in order) for row in rows]
    return sorted(shaped, key=lambda row: tuple((v is None, str(v)) for v in row))


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), rows_of(df.columns, [tuple(row) for row in df.collect()])


def oracle_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), rows_of(columns, result.fetchall())


def difference(df, con, sql: str) -> str | None:
    """What differs, or None."""
    columns, got = spark_rows(df)
    wanted_columns, wanted = oracle_rows(con, sql)
    if columns != wanted_columns:
        return f"columns {columns} != {wanted_columns}"
    if len(got) != len(wanted):
        return f"{len(got)} rows != {len(wanted)} rows"
    for mine, theirs in zip(got, wanted):
        if mine != theirs:
            return f"{columns}: {mine} != {theirs}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from conftest import make_session

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else SF_DIR
    names = sys.argv[2:] or list(entry.queries())
    spark, con = make_session(), duckdb_over(folder)
    for name in names:
        started = time.time()
        try:
            df = entry.queries()[name](spark, folder)
            problem = (
                difference(df, con, entry.oracle_sql()[name])
                if name in entry.oracle_sql()
                else "no oracle"
            )
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        count = "" if problem else f"{df.count()} rows"
        print(f"{name:28s} {time.time() - started:6.2f}s {problem or 'ok ' + count}", flush=True)
