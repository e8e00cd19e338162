"""Run queries and their checking SQL side by side and compare types and values.

``python tests/oracle.py [sf] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b


def compare(df, con, sql: str) -> str:
    """Empty text when both sides agree, otherwise the first difference."""
    left_types = {f.name: f.dataType.simpleString() for f in df.schema}
    order = sorted(left_types)
    left = [tuple(r[c] for c in order) for r in df.collect()]
    # As a view, as a checking statement may be used.
    con.execute(f"CREATE OR REPLACE VIEW checked AS {sql}")
    result = con.execute("SELECT * FROM checked")
    right_types = {d[0]: str(d[1]) for d in result.description}
    if sorted(right_types) != order:
        return f"columns {order} != {sorted(right_types)}"
    for c in order:
        if TYPES.get(left_types[c], left_types[c]) != right_types[c]:
            return f"type of {c}: {left_types[c]} != {right_types[c]}"
    names = [d[0] for d in result.description]
    positions = [names.index(c) for c in order]
    right = [tuple(r[i] for i in positions) for r in result.fetchall()]
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    left.sort(key=_key)
    right.sort(key=_key)
    bad = [(a, b) for a, b in zip(left, right) if not all(_same(x, y) for x, y in zip(a, b))]
    if bad:
        return f"{len(bad)} of {len(left)} rows differ, first {dict(zip(order, zip(*bad[0])))}"
    return ""


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from tillcast.session import local_session

    sf = argv[0] if argv else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = local_session(8), connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in argv[1:] or list(queries):
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            problem = compare(df, con, sql[name]) if name in sql else f"rows only: {df.count()}"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        ok = not problem or problem.startswith("rows only")
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {time.time() - start:6.2f}s {name} {problem}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
