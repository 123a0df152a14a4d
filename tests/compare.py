"""Run registered queries on Spark and their SQL on DuckDB and compare the rows.

    python -m tests.compare [folder] [name-prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time

import duckdb

from corpuslens.session import build_session, release, ship_code
from corpuslens.sources.tables import SCHEMAS
from workload.oracle import all_sql
from workload.queries import QUERIES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in SCHEMAS:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def normalised(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normalised(r[i]) for i in order) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


def difference(spark_df, cursor) -> str | None:
    """None if both results hold the same rows, else a short account."""
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    ours = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(ours)} rows differ, first {str(wrong[0][0])[:300]} against {str(wrong[0][1])[:300]}"
    kinds = [(type(a), type(b)) for a, b in zip(ours[0], theirs[0]) if a is not None and b is not None] if ours else []
    if any(a is not b for a, b in kinds):
        return f"types {kinds}"
    return None


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:]) or ("",)
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir="file://" + tempfile.mkdtemp(prefix="compare-"),
    )
    ship_code(spark, os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "corpuslens", "workload", "tests")
    spark.sparkContext.setLogLevel("ERROR")
    db, sql, failed = connect(folder), all_sql(), []
    for name, fn in QUERIES.items():
        if not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in sql:
                problem = difference(df, db.execute(sql[name]))
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        release(spark)
        kind = "sql" if name in sql else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind:4} {time.time() - start:6.1f}s {name} {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} failed: {' '.join(failed)}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
