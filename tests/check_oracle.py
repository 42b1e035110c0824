"""Compare registered queries with their SQL: ``python -m tests.check_oracle [folder] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _type_name(kind: pa.DataType) -> str:
    if pa.types.is_large_string(kind):
        return "string"
    return str(kind)


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]

    def portable(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else value + 0.0
        return value

    rows = [tuple(portable(v) for v in row) for row in zip(*columns)]
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def difference(spark_table: pa.Table, sql_table: pa.Table) -> str | None:
    """None if schema and rows agree, else the first difference."""
    ours = {f.name: _type_name(f.type) for f in spark_table.schema}
    theirs = {f.name: _type_name(f.type) for f in sql_table.schema}
    if ours != theirs:
        wrong = {n: (ours.get(n), theirs.get(n)) for n in ours.keys() | theirs.keys() if ours.get(n) != theirs.get(n)}
        return f"schema differs: {wrong}"
    left, right = _rows(spark_table), _rows(sql_table)
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(left)} rows differ, first: {wrong[0]}"
    return None


def main(folder: str = "/root/testdata/sf0.001", *names: str) -> int:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import local_session

    spark = local_session()
    sql, bad = oracle_sql(), 0
    connection = connect(folder)
    for name, query in queries().items():
        if names and name not in names:
            continue
        begin = time.time()
        try:
            ours = query(spark, folder).toArrow()
            taken = time.time() - begin
            if name in sql:
                problem = difference(ours, connection.execute(sql[name]).to_arrow_table())
            else:
                problem = None if ours.num_rows else "no rows"
        except Exception as error:  # report and go on with the next query
            taken, problem = time.time() - begin, f"{type(error).__name__}: {str(error)[:900]}"
        bad += problem is not None
        rows = "" if problem else f"{ours.num_rows} rows"
        print(f"{'FAIL' if problem else 'ok  '} {name:32s} {taken:6.2f}s {rows} {problem or ''}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
