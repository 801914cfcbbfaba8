"""Run registered queries next to their SQL twins and compare the rows.

python tools/check.py [sf_dir] [name prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from agrospark.catalog import REGISTRY  # noqa: E402
from agrospark.session import get_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    return repr(value)


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def compare(columns, rows, oracle_columns, oracle_rows) -> str | None:
    if sorted(columns) != sorted(oracle_columns):
        return f"columns {sorted(columns)} != {sorted(oracle_columns)}"
    if len(rows) != len(oracle_rows):
        return f"{len(rows)} rows != {len(oracle_rows)}"
    order = sorted(columns)
    ours = sorted(tuple(normal(r[columns.index(c)]) for c in order) for r in rows)
    theirs = sorted(tuple(normal(r[oracle_columns.index(c)]) for c in order) for r in oracle_rows)
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} rows differ, first {order}\n   ours   {wrong[0][0]}\n   theirs {wrong[0][1]}" if wrong else None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = get_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name, q in REGISTRY.items():
        if prefixes and not any(name == p or name.startswith(p + "_") for p in prefixes):
            continue
        start = time.time()
        try:
            df = q.run(spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            took = time.time() - start
            if q.sql is None:
                print(f"rows {name:32s} {len(rows):8d} rows {took:6.2f}s", flush=True)
                continue
            start = time.time()
            cur = con.execute(q.sql)
            names = [d[0] for d in cur.description]
            oracle = cur.fetchall()
            problem = compare(df.columns, rows, names, oracle)
            print(f"{'FAIL' if problem else 'ok  '} {name:32s} {len(rows):8d} rows {took:6.2f}s oracle {time.time() - start:5.2f}s"
                  + (f"\n   {problem}" if problem else ""), flush=True)
            failed += bool(problem)
        except Exception as e:  # report and go on with the next query
            failed += 1
            print(f"ERR  {name}: {type(e).__name__} {str(e)[:1500]}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    raise SystemExit(main() > 0)
