"""Runs registered queries against their check SQL on one data folder."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


SAME_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else number + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, con, sf_dir: str, name: str, query, sql: str) -> list[str]:
    df = query(spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = dict(zip(names, (str(d[1]) for d in result.description)))
    theirs = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    notes = [
        f"type of {c}: {t} against {kinds[c]}"
        for c, t in df.dtypes
        if SAME_TYPES.get(t.split("(")[0], t) != kinds[c].split("(")[0]
    ]
    if ours == theirs:
        return notes
    missing = [r for r in theirs if r not in set(ours)][:3]
    extra = [r for r in ours if r not in set(theirs)][:3]
    return [f"{len(ours)} rows against {len(theirs)}", f"missing {missing}", f"extra {extra}"]


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    checks = contract.oracle_sql()
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in checks:
                found = differences(spark, con, sf_dir, name, query, checks[name])
            else:
                print(f"rows {name} {query(spark, sf_dir).count()} (no check SQL)", flush=True)
                continue
        except Exception as problem:  # noqa: BLE001 - report and go on
            found = [f"{type(problem).__name__}: {str(problem)[:600]}"]
        print(f"{'ok  ' if not found else 'FAIL'} {name} {time.time() - start:.1f}s", *found, sep="\n     " if found else " ", flush=True)
