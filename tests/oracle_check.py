"""Compare every registered query with its SQL: ``python tests/oracle_check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    return value


def normal_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def differences(con, df, sql: str) -> str | None:
    """None when the query and the SQL give the same bag of rows."""
    relation = con.sql(sql)
    ours = normal_rows(df.columns, df.collect())
    theirs = normal_rows(relation.columns, relation.fetchall())
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(ours)} rows differ, first {wrong[0]}"
    kinds = {k: (type(a).__name__, type(b).__name__) for k, a, b in _typed(ours, theirs, df.columns)}
    mixed = {k: v for k, v in kinds.items() if v[0] != v[1]}
    return f"types {mixed}" if mixed else None


def _typed(ours, theirs, columns):
    for a, b in zip(ours[:50], theirs[:50]):
        for k, u, v in zip(sorted(columns), a, b):
            if u is not None:
                yield k, u, v


def main() -> int:
    from pyspark.sql import SparkSession

    from workloads.oracle import ORACLE
    from workloads.queries import QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name in names:
        started = time.monotonic()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLE:
                problem = differences(con, df, ORACLE[name])
            else:
                problem = f"no SQL, {len(df.collect())} rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'DIFF'} {time.monotonic() - started:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} match; without SQL: {sorted(set(QUERIES) - set(ORACLE))}")
    return failed


if __name__ == "__main__":
    sys.exit(main())
