"""Run registered queries next to their checking SQL: `python -m tests.compare [sf_dir] [names...]`."""

from __future__ import annotations

import sys
import time
import traceback

import duckdb
import numpy as np
import pandas as pd

import __spark_entry__ as register

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and np.isnan(value)):
        return "NULL"
    if isinstance(value, (bool, np.bool_)):
        return str(bool(value))
    if isinstance(value, (float, np.floating)):
        return f"{value:.9g}"
    return str(value)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> str:
    """'' if both sides agree, else what differs."""
    got = register.queries()[name](spark, sf_dir)
    sql = register.oracle_sql().get(name)
    found = [tuple(r) for r in got.collect()]
    if sql is None:
        return ""
    relation = con.sql(sql)
    wanted_columns = list(relation.columns)
    wanted = relation.fetchall()
    if sorted(got.columns) != sorted(wanted_columns):
        return f"columns {sorted(got.columns)} / {sorted(wanted_columns)}"
    types = dict(zip(relation.columns, map(str, relation.types)))
    left, right = rows_of(got.columns, found), rows_of(wanted_columns, wanted)
    if not right:
        return "no rows"
    if left != right:
        only_left = sorted(set(left) - set(right))[:3]
        only_right = sorted(set(right) - set(left))[:3]
        return f"{len(left)} / {len(right)} rows; {sorted(got.columns)}\n   spark only {only_left}\n   sql only   {only_right}"
    same = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "INTEGER"}
    odd = [f"{c}: {t} / {types[c]}" for c, t in got.dtypes if same.get(t) != types[c]]
    return ("TYPES " + ", ".join(odd)) if odd else ""


def main() -> int:
    from tests.conftest import local_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark, con = local_session(), connect(sf_dir)
    bad = 0
    for name in args or list(register.queries()):
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:
            problem = "".join(traceback.format_exception_only(error))[:1500]
        bad += bool(problem) and not problem.startswith("TYPES")
        print(f"{name:24s} {time.time() - start:6.2f}s {'ok' if not problem else problem}", flush=True)
    print("different:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
