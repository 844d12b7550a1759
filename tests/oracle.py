"""Run registered queries and their SQL twins side by side.

``python tests/oracle.py [sf_dir] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return str(v) if hasattr(v, "isoformat") or type(v).__name__ == "Decimal" else v


def rows(columns, data) -> tuple[list, list]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_value(row[i]) for i in order) for row in data]
    table.sort(key=lambda row: tuple((v is None, str(v)) for v in row))
    return [columns[i] for i in order], table


def compare(spark_df, relation) -> str:
    """Empty when both results hold the same rows."""
    ours = rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    theirs = rows(relation.columns, relation.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} vs {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} vs {len(theirs[1])} rows"
    for a, b in zip(ours[1], theirs[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{str(a)[:300]} vs {str(b)[:300]}"
    return ""


def brief(problem: str) -> str:
    """The first line and any cause."""
    lines = problem.splitlines()
    told = [line.strip() for line in lines if "Caused by" in line or "- object" in line or "- field" in line]
    return " | ".join(lines[:1] + told)[:1500]


def main() -> None:
    import __spark_entry__ as contract
    from doclake.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session(
        "oracle",
        "local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=8,
        spark__driver__memory="10g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    sql, connection = contract.oracle_sql(), duck(sf_dir)
    names = sys.argv[2:] or list(contract.queries())
    failed = 0
    for name in names:
        start = time.time()
        try:
            result = contract.queries()[name](spark, sf_dir)
            if name in sql:
                problem = compare(result, connection.sql(sql[name]))
            else:
                problem = "" if result.count() else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:20000]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        failed += bool(problem)
        kind = "sql " if name in sql else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {time.time() - start:6.2f}s {name} {brief(problem)}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal; SQL without query: {set(sql) - set(contract.queries())}")


if __name__ == "__main__":
    main()
