"""Compare every registered query with its SQL: ``python tools/check.py [folder] [name …]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from merkato.plans.catalog import QUERIES, SQL  # noqa: E402
from merkato.session import build_session  # noqa: E402
from merkato.sources.tpch import TABLES  # noqa: E402

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def text(value):
    if value is None:
        return "∅"
    if isinstance(value, float):
        return "∅" if math.isnan(value) else repr(value)
    return str(value)


def differences(df, con, sql: str) -> str | None:
    """None where columns, types and rows agree, otherwise what differs."""
    columns = sorted(df.columns)
    expected = con.sql(sql)
    theirs = dict(zip(expected.columns, map(str, expected.types)))
    if sorted(theirs) != columns:
        return f"columns {columns} vs {sorted(theirs)}"
    mine = dict(df.dtypes)
    kinds = [(c, mine[c], theirs[c]) for c in columns if KINDS.get(mine[c]) != theirs[c]]
    left = sorted(tuple(text(row[c]) for c in columns) for row in df.select(*[f"`{c}`" for c in columns]).collect())
    order = [expected.columns.index(c) for c in columns]
    right = sorted(tuple(text(row[i]) for i in order) for row in expected.fetchall())
    if left != right:
        extra = [x for x in left if x not in set(right)][:2]
        lost = [x for x in right if x not in set(left)][:2]
        return f"{len(left)} vs {len(right)} rows; only here {extra}; only SQL {lost}"
    return f"types {kinds}" if kinds else None


def main() -> int:
    arguments = sys.argv[1:]
    folder = arguments.pop(0) if arguments and os.path.isdir(arguments[0]) else "/root/testdata/sf0.01"
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), []
    for name, run in QUERIES.items():
        if arguments and not any(name.startswith(a) for a in arguments):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in SQL:
                problem = differences(df, con, SQL[name])
                verdict = "same" if problem is None else f"DIFFERS {problem}"
            else:
                verdict = f"rows {df.count()}"
        except Exception as error:  # report and go on with the next query
            verdict = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        if verdict.startswith(("DIFF", "FAIL")):
            failed.append(name)
        print(f"{name:34} {time.time() - start:6.1f}s  {verdict}", flush=True)
    print(f"{len(failed)} of {len(QUERIES)} need attention: {failed}")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
