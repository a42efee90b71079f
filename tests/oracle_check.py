"""Compare queries with their SQL: ``python tests/oracle_check.py <sf_dir> [name ...]``."""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return value + 0.0
    return value


def row_set(pdf):
    columns = sorted(pdf.columns)
    table = pdf[columns].astype(object)
    rows = [tuple(normal(v) for v in row) for row in table.itertuples(index=False)]
    return columns, sorted(rows, key=repr)


def compare(got, want):
    """None when equal, else a short account of the first difference."""
    got_columns, got_rows = row_set(got)
    want_columns, want_rows = row_set(want)
    if got_columns != want_columns:
        return f"columns {got_columns} vs {want_columns}"
    if len(got_rows) != len(want_rows):
        return f"rows {len(got_rows)} vs {len(want_rows)}"
    for mine, theirs in zip(got_rows, want_rows):
        if mine != theirs:
            return f"{mine} vs {theirs}"
    return None


def duck(sf_dir):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


if __name__ == "__main__":
    from depthgrid.session import build_session
    import __spark_entry__ as contract

    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    folder, names = sys.argv[1], sys.argv[2:]
    database, bad = duck(folder), 0
    for name, query in contract.queries().items():
        if names and name not in names:
            continue
        begin = time.time()
        try:
            got = query(spark, folder).toPandas()
            sql = contract.oracle_sql().get(name)
            verdict = compare(got, database.execute(sql).df()) if sql else "rows only"
        except Exception as error:  # report and go on with the next query
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
            got = ()
        bad += verdict not in (None, "rows only")
        print(f"{name:24s} {len(got):8d} rows {time.time() - begin:6.1f}s  {verdict or 'ok'}", flush=True)
    print("differences:", bad)
