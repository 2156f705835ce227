"""Compare queries with their oracles: ``python -m acceptance.check <data directory> [query ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

from acceptance.oracles import ORACLES
from acceptance.queries import QUERIES


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], Counter]:
    """Sorted columns and row multiset of an oracle."""
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    result = connection.execute(sql)
    return _multiset([column[0] for column in result.description], result.fetchall())


def spark_rows(frame: DataFrame) -> tuple[list[str], Counter]:
    """Sorted columns and row multiset of a query's result."""
    return _multiset(frame.columns, [tuple(row) for row in frame.collect()])


def _multiset(columns: list[str], rows: list[tuple]) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], Counter(tuple(repr(row[i]) for i in order) for row in rows)


def main(sf_dir: str, *names: str) -> int:
    from eventlake.session import session

    spark = session("acceptance", {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
        seconds = time.time() - start
        if name not in ORACLES:
            verdict = "no oracle"
        else:
            expected_columns, expected = oracle_rows(sf_dir, ORACLES[name])
            verdict = "equal" if (columns, rows) == (expected_columns, expected) else "DIFFERENT"
            if verdict == "DIFFERENT":
                bad += 1
                verdict += f" {columns} {expected_columns}"
                verdict += f" extra {list((rows - expected).items())[:3]} missing {list((expected - rows).items())[:3]}"
        print(f"{name}: {rows.total()} rows, {seconds:.2f} s, {verdict}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
