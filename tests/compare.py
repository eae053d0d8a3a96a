"""Run registered queries next to their SQL twins and compare rows. ``python tests/compare.py sf [name ...]``"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(folder: str):
    import duckdb
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def normal(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if hasattr(value, "as_tuple"):
        return float(value)
    return value


def as_set(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, con, folder, name, entry) -> str:
    """Empty when query and twin agree."""
    df = entry.queries()[name](spark, folder)
    left = as_set(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(entry.oracle_sql()[name])
    right = as_set([d[0] for d in result.description], result.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} vs {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} vs {len(right[1])}"
    wrong = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else ""


if __name__ == "__main__":
    import __spark_entry__ as entry
    from labelloom.session import local_session
    folder = f"/root/testdata/sf{sys.argv[1]}"
    session, con = local_session(8), duck(folder)
    for name in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            if name in entry.oracle_sql():
                result = difference(session, con, folder, name, entry) or "same"
            else:
                result = f"rows only: {len(entry.queries()[name](session, folder).collect())}"
        except Exception as error:
            result = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{time.time() - start:7.1f}s  {name}: {result[:700]}", flush=True)
