"""Run registered queries against their DuckDB SQL on one folder of test tables."""

from __future__ import annotations

import datetime
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, bool):
        return v
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


_KINDS = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def check(spark, con, name: str, folder: str) -> list[str]:
    """Differences between the two results; empty when they are equal."""
    df = contract.queries()[name](spark, folder)
    sql = contract.oracle_sql().get(name)
    rows = [tuple(x) for x in df.collect()]
    if sql is None:
        return []
    cur = con.execute(sql)
    types = {d[0]: str(d[1]) for d in cur.description}
    want_cols, want = canonical([d[0] for d in cur.description], cur.fetchall())
    got_cols, got = canonical(df.columns, rows)
    problems = []
    if want_cols != got_cols:
        return [f"columns {got_cols} want {want_cols}"]
    for field in df.schema.fields:
        kind = _KINDS.get(field.dataType.simpleString(), field.dataType.simpleString())
        if types[field.name] != kind:
            problems.append(f"type of {field.name}: {kind} want {types[field.name]}")
    if len(got) != len(want):
        problems.append(f"{len(got)} rows want {len(want)}")
    diff = [(g, w) for g, w in zip(got, want) if repr(g) != repr(w)]
    if diff:
        g, w = diff[0]
        cols = [(c, x, y) for c, x, y in zip(got_cols, g, w) if repr(x) != repr(y)]
        problems.append(f"{len(diff)} rows differ, first {cols} in {w}")
    return problems


def main() -> int:
    from pyspark.sql import SparkSession

    folder = sys.argv[1]
    names = sys.argv[2:] or list(contract.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problems = check(spark, con, name, folder)
        except Exception as e:  # report and go on with the next query
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(problems)
        kind = "" if name in contract.oracle_sql() else " (rows only)"
        print(f"{'FAIL' if problems else 'ok'} {name}{kind} {time.time() - start:.1f}s", *problems, sep="\n    " if problems else " ", flush=True)
    print(f"{len(names)} queries, {bad} failed")
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
