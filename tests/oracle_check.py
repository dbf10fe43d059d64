"""Compare registered queries with their SQL on the retail tables.

As a script: ``python tests/oracle_check.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["orders", "lineitem", "part"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    plain = frame.astype(object).where(frame.notna(), None)
    return sorted((tuple(map(str, row)) for row in plain.itertuples(index=False)))


def _type(kind) -> str:
    text = str(kind).lower()
    names = {"bigint": "long", "varchar": "string", "integer": "int", "timestamp_ntz": "timestamp"}
    return names.get(text, text.replace("decimal(", "decimal(").replace(", ", ","))


def difference(spark, con, name: str, run, sql: str, sf_dir: str) -> str | None:
    """None when both sides agree, else what differs."""
    result = run(spark, sf_dir)
    expected = con.sql(sql)
    left = {f.name: _type(f.dataType.simpleString()) for f in result.schema.fields}
    left = {k: "long" if v == "bigint" else v for k, v in left.items()}
    right = dict(zip(expected.columns, map(_type, expected.types)))
    if left != right:
        return f"{name}: schema {set(left.items()) ^ set(right.items())}"
    got = _rows(pd.DataFrame([r.asDict() for r in result.collect()], columns=result.columns, dtype=object))
    want = _rows(pd.DataFrame(expected.fetchall(), columns=expected.columns, dtype=object))
    if got != want:
        only_got = [r for r in got if r not in set(want)][:2]
        only_want = [r for r in want if r not in set(got)][:2]
        return f"{name}: {len(got)} rows, {len(want)} expected\n  got  {only_got}\n  want {only_want}"
    if not got:
        return f"{name}: no rows to compare"
    return None


def main() -> int:
    from orderloom.registry.queries import ORACLE, QUERIES
    from orderloom.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(QUERIES)
    spark, con, bad = local_session("check", "8"), connect(sf_dir), 0
    for name in names:
        start = time.time()
        if name in ORACLE:
            problem = difference(spark, con, name, QUERIES[name], ORACLE[name], sf_dir)
        else:
            problem = None if QUERIES[name](spark, sf_dir).count() else f"{name}: no rows"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s", problem or "", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
