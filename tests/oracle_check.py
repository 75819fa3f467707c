"""Compare every registered query with its SQL twin: python tests/oracle_check.py [sf] [names...]"""

import datetime
import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))


def compare(spark, con, name, sf_dir, queries, oracles) -> tuple[str, int, str]:
    df = queries[name](spark, sf_dir)
    mine = normal([tuple(r) for r in df.collect()], df.columns)
    if name not in oracles:
        return "rows-only", len(mine), ""
    cur = con.execute(oracles[name])
    names = [d[0] for d in cur.description]
    theirs = normal(cur.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return "columns", len(mine), f"{sorted(df.columns)} / {sorted(names)}"
    if mine != theirs:
        only_a = [r for r in mine if r not in set(theirs)][:2]
        only_b = [r for r in theirs if r not in set(mine)][:2]
        return "values", len(mine), f"{len(mine)}/{len(theirs)} spark {only_a} sql {only_b}"
    return ("ok" if mine else "empty"), len(mine), ""


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = f"{TESTDATA}/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            status, n, note = compare(spark, con, name, sf_dir, queries, oracles)
        except Exception as error:
            status, n, note = "error", 0, str(error)[:1500]
        bad += status not in ("ok", "rows-only")
        print(f"{status:10} {name:32} {n:7} {time.time() - start:6.2f}s {note[:1500]}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
