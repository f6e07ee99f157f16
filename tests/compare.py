"""Run registered queries beside their SQL and compare rows; usable as a script."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return round(value, 9)
    if isinstance(value, dt.datetime) and value.tzinfo:
        return value.replace(tzinfo=None)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((v is not None, str(v)) for v in row),
    )


def spark_rows(frame):
    return canonical(frame.columns, [tuple(r) for r in frame.collect()])


def sql_rows(con, sql):
    result = con.sql(sql)
    return canonical(result.columns, result.fetchall())


# Column types of both engines under one name.
SQL_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "date": "DATE",
             "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "double": "DOUBLE", "decimal(18,2)": "DECIMAL(18,2)"}


def spark_types(frame):
    return {f.name: SQL_TYPES[f.dataType.simpleString()] for f in frame.schema.fields}


def sql_types(con, sql):
    result = con.sql(sql)
    return {name: str(kind) for name, kind in zip(result.columns, result.types)}


def main(sf_dir, names):
    import __spark_entry__ as entry
    from viewtide.session import build_session

    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), entry.oracle_sql(), []
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            frame = query(spark, sf_dir)
            got, kinds = spark_rows(frame), spark_types(frame)
            took = time.time() - started
            want, want_kinds = sql_rows(con, oracles[name]), sql_types(con, oracles[name])
            ok = got == want and kinds == want_kinds
            note = ""
            if not ok:
                diff = [(a, b) for a, b in zip(got, want) if a != b][:2]
                types = {k: (v, want_kinds.get(k)) for k, v in kinds.items() if want_kinds.get(k) != v}
                note = f" want {len(want)} {diff} {types}"
        except Exception as error:  # report and go on
            ok, got, took, note = False, [], time.time() - started, f" {type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok ' if ok else 'BAD'} {name:28s} {len(got):7d} rows {took:6.2f}s{note}", flush=True)
        if not ok:
            bad.append(name)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
