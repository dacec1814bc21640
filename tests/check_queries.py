"""Run registered queries on Spark and their SQL on DuckDB and compare rows.

    python tests/check_queries.py [folder] [name prefix ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else v
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    return v


def sort_key(row):
    return tuple((v is not None, str(v)) for v in row)


def compare(df, con, statement) -> str:
    """'' where equal, else what differs."""
    names = sorted(df.columns)
    mine = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=sort_key)
    con.execute(statement)
    theirs_names = [d[0] for d in con.description]
    if sorted(theirs_names) != names:
        return f"columns {names} / {sorted(theirs_names)}"
    at = [theirs_names.index(n) for n in names]
    theirs = sorted((tuple(plain(r[i]) for i in at) for r in con.fetchall()), key=sort_key)
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{names}\n  spark {str(a)[:900]}\n  sql   {str(b)[:900]}"
    return ""


def main() -> int:
    import __spark_entry__ as entry
    from triagelake.session import get_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = tuple(sys.argv[2:])
    spark = get_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                        spark__driver__memory="12g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    statements, bad = entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if wanted and not name.startswith(wanted):
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            note = compare(df, con, statements[name]) if name in statements else f"(no SQL) rows {df.count()}"
        except Exception as error:  # report and go on
            note = "ERROR " + str(error).split("\n")[0][:400]
        failed = bool(note) and not note.startswith("(no SQL)")
        bad += failed
        print(f"{'BAD ' if failed else 'ok  '} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{bad} bad", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
