"""Compare every query with its SQL: python tests/check_oracles.py [folder] [query ...]."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from flowtide.session import job_tables  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, int) and not isinstance(value, bool):
        return repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, connection, folder, build, sql) -> tuple[bool, str]:
    """Whether both sides agree in columns, row count and every value."""
    with job_tables(spark):
        frame = build(spark, folder)
        ours = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(sql)
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return False, f"columns {ours[0]} / {theirs[0]}"
    if ours[1] == theirs[1]:
        return True, f"{len(ours[1])} rows"
    apart = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    return False, f"rows {len(ours[1])} / {len(theirs[1])}, first difference {apart[:1]}"


def main() -> None:
    from conftest import session
    from __spark_entry__ import oracle_sql, queries

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, connection = session(), database(folder)
    oracles = oracle_sql()
    for name, build in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracles:
                good, note = compare(spark, connection, folder, build, oracles[name])
            else:
                with job_tables(spark):
                    good, note = True, f"{build(spark, folder).count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001
            good, note = False, f"{type(error).__name__}: {str(error)[:400]}"
        print(f"{'ok  ' if good else 'FAIL'} {name:24s} {time.time() - start:6.2f}s  {note}", flush=True)


if __name__ == "__main__":
    main()
