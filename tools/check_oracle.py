"""Compare named queries with their SQL: `python tools/check_oracle.py [folder] [name ...]`."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb
from pyspark.sql import SparkSession

from palisade.catalog import all_queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def oracle(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name, q):
    df = q.build(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    if not q.oracle:
        return f"rows only ({len(rows)})", bool(rows)
    cur = con.execute(q.oracle)
    columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}", False
    got, want = canonical(df.columns, rows), canonical(columns, want)
    if got == want:
        return f"ok ({len(rows)} rows)", True
    left, right = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    show = lambda xs: "\n    ".join(str(x)[:600] for x in xs[:2])
    return f"DIFFERS {len(got)}/{len(want)} rows, {len(left)} only ours\n  ours\n    {show(left)}\n  oracle\n    {show(right)}", False


if __name__ == "__main__":
    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark, con, bad = session(), oracle(folder), []
    for name, q in all_queries().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            text, good = compare(spark, con, folder, name, q)
        except Exception as e:  # noqa: BLE001
            text, good = f"FAILED {type(e).__name__}: {str(e)[:400]}", False
        if not good:
            bad.append(name)
        print(f"{name:22s} {time.time() - start:6.2f}s {text}", flush=True)
    print("bad:", bad)
