"""Run registered queries against their SQL: python tests/check_oracles.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry
from leafmill.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


spent = {"start": 0.0, "spark": 0.0}


def compare(spark, con, name: str, sf_dir: str) -> str:
    """'' if rows agree, else what differs."""
    frame = entry.queries()[name](spark, sf_dir)
    columns = sorted(frame.columns)
    got = Counter(tuple(plain(v) for v in row) for row in frame.select(*columns).collect())
    spent["spark"] = time.time() - spent["start"]
    result = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}"
    order = [names.index(c) for c in columns]
    want = Counter(tuple(plain(row[i]) for i in order) for row in result.fetchall())
    types = {
        "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN",
    }
    spark_kinds = {f.name: types.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in frame.schema.fields}
    if spark_kinds != kinds:
        return f"types {spark_kinds} against {kinds}"
    if got != want:
        return f"rows {sum(got.values())} against {sum(want.values())}; only Spark {list((got - want).items())[:2]}; only SQL {list((want - got).items())[:2]}"
    return "" if got else "no rows"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = database(sf_dir)
    failed = 0
    for name in names:
        start = spent["start"] = time.time()
        try:
            said = compare(spark, con, name, sf_dir) if name in entry.oracle_sql() else "no SQL"
        except Exception as problem:
            said = f"{type(problem).__name__}: {str(problem)[:1500]}"
        failed += bool(said)
        print(f"{'ok  ' if not said else 'FAIL'} {name} {time.time() - start:.1f}s (Spark {spent['spark']:.1f}s) {said[:600]}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
