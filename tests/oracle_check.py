"""Run registered Spark queries and their DuckDB oracles side by side.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: rows, column match and value match.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from tessera.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if os.environ.get("STRICT") else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    if os.environ.get("VANILLA"):
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]")
                 .config("spark.sql.session.timeZone", os.environ.get("VANILLA_TZ", "America/Los_Angeles"))
                 .config("spark.ui.enabled", "false").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = build_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        cols = df.columns
        if name not in sqls:
            print(f"{name:32s} spark_rows={len(rows):7d} (no oracle) {t1-t0:.1f}s")
            continue
        rel = con.sql(sqls[name])
        ocols = rel.columns
        orows = rel.fetchall()
        t2 = time.time()
        same_cols = sorted(cols) == sorted(ocols)
        same_vals = same_cols and canon(rows, cols) == canon(orows, ocols)
        types = list(zip(cols, [f.dataType.simpleString() for f in df.schema.fields]))
        otypes = list(zip(ocols, [str(t) for t in rel.types]))
        ok = same_cols and same_vals and len(rows) == len(orows)
        bad += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} spark={len(rows):7d} duck={len(orows):7d} "
              f"cols={same_cols} vals={same_vals} spark {t1-t0:.1f}s duck {t2-t1:.1f}s")
        if not ok or os.environ.get("SHOW_TYPES"):
            print("   spark:", types)
            print("   duck :", otypes)
            if same_cols and not same_vals:
                a, b = canon(rows, cols), canon(orows, ocols)
                diff = [x for x in a if x not in set(b)][:3]
                print("   only spark:", diff)
                print("   only duck :", [x for x in b if x not in set(a)][:3])
    spark.stop()
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
