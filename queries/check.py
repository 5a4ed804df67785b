"""Compare every registered query with its SQL.

    python -m queries.check /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from cohortkit import build_session, scratch
from queries import oracle_sql, queries


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple(str(v) for v in t)
    )


def main(folder: str, names: list[str]) -> int:
    spark = build_session("local[8]", 8, **{"spark.sql.session.timeZone": "UTC"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for f in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    bad = 0
    sql = oracle_sql()
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            with scratch(spark):
                df = query(spark, folder)
                got = rows_of(df.columns, [tuple(r) for r in df.collect()])
        except Exception as error:  # report and go on with the next query
            bad += 1
            print(f"FAIL {name}: {type(error).__name__}: {str(error)[:600]}")
            continue
        took = time.time() - start
        if name not in sql:
            print(f"rows {name}: {len(got)} rows, {took:.2f}s (no SQL)")
            continue
        try:
            cur = con.execute(sql[name])
            columns = [d[0] for d in cur.description]
            types = {d[0]: str(d[1]) for d in cur.description}
            want = rows_of(columns, cur.fetchall())
        except Exception as error:
            bad += 1
            print(f"FAIL {name}: SQL {str(error)[:600]}")
            continue
        pairs = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}
        types_differ = [
            (c, t, dict(df.dtypes)[c]) for c, t in types.items()
            if c in df.columns and pairs.get(t, dict(df.dtypes)[c]) != dict(df.dtypes)[c]
        ]
        if sorted(columns) != sorted(df.columns):
            bad += 1
            print(f"FAIL {name}: columns {sorted(df.columns)} vs {sorted(columns)}")
        elif got != want:
            bad += 1
            diff = [(g, w) for g, w in zip(got, want) if g != w][:2]
            print(f"FAIL {name}: {len(got)} vs {len(want)} rows; {diff}")
        else:
            print(f"ok   {name}: {len(got)} rows, {took:.2f}s" + (f" TYPES {types_differ}" if types_differ else ""))
    print(f"{bad} failures")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
