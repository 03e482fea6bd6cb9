"""Run registered queries next to their SQL twins and compare all values.

``python tests/compare.py [sf_dir] [name ...]`` prints one line per query.
"""

import glob
import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value)


def digest(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    lines = sorted("\x1f".join(canonical(row[i]) for i in order) for row in rows)
    return sorted(names), len(lines), hashlib.md5("\x1e".join(lines).encode()).hexdigest()


def spark_digest(df):
    return digest(df.columns, df.collect())


def sql_digest(con, sql):
    result = con.execute(sql)
    return digest([d[0] for d in result.description], result.fetchall())


def main(argv):
    import __spark_entry__ as entry
    from clipyard.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in argv[1:] or queries:
        start = time.time()
        try:
            got = spark_digest(queries[name](spark, sf_dir))
            spent = time.time() - start
            want = sql_digest(con, oracle[name]) if name in oracle else got
            state = "ok" if got == want else f"DIFFERS {got} {want}"
        except Exception as error:  # report and go on with the next query
            spent, state = time.time() - start, f"ERROR {str(error)[:600]}"
        bad += state != "ok"
        print(f"{name:30s} {spent:6.2f}s sql {time.time() - start - spent:6.2f}s {state}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
