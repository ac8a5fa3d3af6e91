"""Compare registered queries with their SQL: python tests/check.py [sf] [name …]"""

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def duck(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS FROM '{folder}/{table}.parquet'")
    return connection


def normal(row):
    return tuple("nan" if isinstance(v, float) and math.isnan(v) else (0.0 if v == 0 and isinstance(v, float) else v)
                 for v in row)


def compare(spark, connection, name, function, sql, folder):
    """Text of the first difference, or None."""
    frame = function(spark, folder)
    columns = sorted(frame.columns)
    got = [normal(r) for r in frame.select(*columns).collect()]
    answer = connection.sql(sql)
    if sorted(answer.columns) != columns:
        return f"columns {columns} against {sorted(answer.columns)}"
    kinds = dict(zip(answer.columns, (DUCK_TYPES.get(str(t), str(t)) for t in answer.types)))
    wrong = {c: (k, kinds[c]) for c, k in frame.dtypes if kinds[c] != k}
    if wrong:
        return f"types {wrong}"
    place = [answer.columns.index(c) for c in columns]
    expected = [normal([r[i] for i in place]) for r in answer.fetchall()]
    if len(got) != len(expected):
        return f"{len(got)} rows against {len(expected)}"
    key = lambda row: tuple((v is None, str(v)) for v in row)
    got.sort(key=key)
    expected.sort(key=key)
    bad = [(g, e) for g, e in zip(got, expected) if g != e]
    if bad:
        g, e = bad[0]
        cells = [(c, a, b) for c, a, b in zip(columns, g, e) if a != b][:4]
        return f"{len(bad)} of {len(got)} rows differ, e.g. {cells} in {g[:6]}"
    return None


def main():
    import __spark_entry__ as entry
    from kinfold.session import local_session

    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    folder = f"/root/testdata/sf{scale}"
    spark = local_session(8)
    connection = duck(folder)
    sqls = entry.oracle_sql()
    failed = 0
    for name, function in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, connection, name, function, sqls[name], folder)
            else:
                problem = None
                print(f"     {name}: rows only, {function(spark, folder).count()} rows")
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print("BAD " if problem else "ok  ", name, f"{time.time() - start:.1f}s", problem or "", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
