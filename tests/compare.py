"""Registered queries against their SQL in DuckDB: ``python -m tests.compare [sf_dir] [names...]``."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
from collections import Counter

import duckdb

import __spark_entry__ as entry_module

TABLES = entry_module.GIVEN


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def as_bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark, connection, sf_dir: str, name: str) -> str | None:
    """Why the two results differ (or the plan pairs all rows), or None."""
    found = entry_module.queries()[name](spark, sf_dir)
    plan = found._jdf.queryExecution().executedPlan().toString()
    bad = [node for node in ("NestedLoopJoin", "CartesianProduct", "BatchEvalPython") if node in plan]
    if bad:
        return f"plan has {bad}"
    result = connection.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(found.columns):
        return f"columns {sorted(found.columns)} against {sorted(columns)}"
    expected = as_bag(columns, result.fetchall())
    actual = as_bag(found.columns, found.collect())
    if actual == expected:
        return None
    return (
        f"{sum(actual.values())} rows against {sum(expected.values())}; "
        f"only here {list((actual - expected).items())[:3]}, only in SQL {list((expected - actual).items())[:3]}"
    )


def main() -> None:
    from tests.conftest import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, connection = make_session(), connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or entry_module.oracle_sql():
        start = time.time()
        try:
            problem = differences(spark, connection, sf_dir, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{time.time() - start:6.2f}s {name}: {problem or 'same'}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
