"""Run registered queries against their SQL counterparts and print what differs.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import oracle_sql
from checks.queries import queries

DEFAULT_DIR = "/root/testdata/sf0.01"


def local_session(cpus: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        db.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return db


def _sorted_rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(df: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when both sides have the same columns and the same rows as multisets."""
    result = db.sql(sql)
    if sorted(df.columns) != sorted(result.columns):
        return [f"columns {sorted(df.columns)} != {sorted(result.columns)}"]
    ours = _sorted_rows(df.columns, [tuple(row) for row in df.collect()])
    theirs = _sorted_rows(result.columns, result.fetchall())
    found = [] if len(ours) == len(theirs) else [f"{len(ours)} rows != {len(theirs)}"]
    unequal = [(a, b) for a, b in zip(ours, theirs) if a != b]
    found += [f"{len(unequal)} rows differ"] if unequal else []
    return found + [f"  spark {a}\n  sql   {b}" for a, b in unequal[:3]]


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else DEFAULT_DIR
    spark, db, texts = local_session(), duck(sf_dir), oracle_sql()
    bad = 0
    for name, query in queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        started = time.time()
        found = differences(query(spark, sf_dir), db, texts[name])
        bad += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {name:22s} {time.time() - started:6.1f}s", flush=True)
        for line in found:
            print(f"     {line}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
