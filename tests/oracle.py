"""Compare a query's rows with the rows of its SQL, run by DuckDB on the same files.

``python tests/oracle.py DIR [name ...]`` checks the named queries, or all of them.
"""

from __future__ import annotations

import datetime
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat(" ")
    if isinstance(value, float) and value == 0.0:
        return 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET lambda_syntax='DISABLE_SINGLE_ARROW'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def sql_rows(con, sql):
    cursor = con.execute(sql)
    return canonical([d[0] for d in cursor.description], cursor.fetchall())


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from caudal.session import local_session

    sf_dir, names = argv[0], argv[1:]
    spark = local_session(8, **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    con = connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        try:
            started = time.time()
            got_columns, got = spark_rows(queries[name](spark, sf_dir))
            took = time.time() - started
            if name not in sql:
                print(f"rows  {name}: {len(got)} rows {took:.1f}s")
                continue
            started = time.time()
            want_columns, want = sql_rows(con, sql[name])
            sql_took = time.time() - started
        except Exception as error:
            bad += 1
            print(f"FAIL  {name}: {type(error).__name__} {str(error)[:1500]}")
            continue
        if (got_columns, got) == (want_columns, want):
            print(f"ok    {name}: {len(got)} rows {took:.1f}s (sql {sql_took:.1f}s)")
        else:
            bad += 1
            left = [r for r in got if r not in set(want)][:3] if len(got) < 200000 else []
            right = [r for r in want if r not in set(got)][:3] if len(want) < 200000 else []
            print(f"DIFF  {name}: {len(got)} vs {len(want)} rows {got_columns} {want_columns}\n  {left}\n  {right}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
