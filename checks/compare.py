"""Run every query against its DuckDB statement: ``python -m checks.compare [sf_dir] [names...]``."""

import glob
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks import oracle, queries


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(rows: list[tuple], columns: list[str]) -> list[tuple]:
    """Rows with columns in name order, as text, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = []
    for row in rows:
        out.append(tuple("NULL" if row[i] is None else repr(row[i]) for i in order))
    return sorted(out)


def differences(spark_df, con, sql: str) -> str | None:
    got = [tuple(r) for r in spark_df.collect()]
    cursor = con.execute(sql)
    want_columns = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    if sorted(spark_df.columns) != sorted(want_columns):
        return f"columns {spark_df.columns} against {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    a, b = canonical(got, spark_df.columns), canonical(want, want_columns)
    for x, y in zip(a, b):
        if x != y:
            return f"{x} against {y}"
    return None


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    statements = oracle.statements()
    bad = 0
    for name, query in queries.registered().items():
        if names and name not in names:
            continue
        start = time.time()
        df = query(spark, sf_dir)
        if name in statements:
            problem = differences(df, con, statements[name])
        else:
            problem = None if df.count() else "no rows"
        bad += problem is not None
        kind = "oracle" if name in statements else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {name} [{kind}] {time.time() - start:.2f}s {problem or ''}", flush=True)
    print("bad:", bad)
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
