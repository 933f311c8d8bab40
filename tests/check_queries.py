"""Run every named query beside its SQL and report differences: python tests/check_queries.py [folder] [names...]"""

from __future__ import annotations

import logging
import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from broadsheet.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def normal(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, folder: str, name: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = entry.queries()[name](spark, folder)
    got = rows_of(df.columns, df.collect())
    text = entry.oracle_sql().get(name)
    if text is None:
        return None if got else "no rows"
    cur = con.execute(text)
    columns = [c[0] for c in cur.description]
    want = rows_of(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got != want:
        only_got = [r for r in got if r not in set(want)][:3] if len(got) < 20000 else []
        only_want = [r for r in want if r not in set(got)][:3] if len(got) < 20000 else []
        return f"{len(got)} rows vs {len(want)}\n   spark {str(only_got)[:900]}\n   sql   {str(only_want)[:900]}"
    return None if got else "agree, but on no rows"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con = local_session(8), database(folder)
    spark.sparkContext.setLogLevel("OFF")
    logging.disable(logging.ERROR)
    bad = 0
    for name in names:
        t = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as e:
            problem = "".join(traceback.format_exception_only(e))[:1500]
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - t:.1f}s", problem or "", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
