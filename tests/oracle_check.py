"""Compare every registered query with its SQL counterpart: python tests/oracle_check.py [sf_dir] [names]"""

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def comparable(frame: pd.DataFrame):
    frame = frame[sorted(frame.columns)]
    out = pd.DataFrame(index=frame.index)
    for name in frame.columns:
        column = frame[name]
        if pd.api.types.is_datetime64_any_dtype(column):
            column = column.astype("datetime64[us]").astype(str)
        elif pd.api.types.is_numeric_dtype(column) and not pd.api.types.is_bool_dtype(column):
            column = column.astype(float).map(lambda x: "" if pd.isna(x) else repr(x))
        else:
            column = column.map(lambda x: "" if x is None or x is pd.NaT else str(x))
        out[name] = column
    return sorted(map(tuple, out.itertuples(index=False))), list(out.columns)


def database(sf_dir):
    base = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        base.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return base


def check(spark, base, sf_dir, name, query, sql):
    """(rows, list of differences, seconds in Spark)"""
    start = time.time()
    found = query(spark, sf_dir).toPandas()
    seconds = time.time() - start
    left, left_names = comparable(found)
    right, right_names = comparable(base.execute(sql).df())
    if left_names != right_names:
        return len(left), [f"columns {left_names} != {right_names}"], seconds
    if left == right:
        return len(left), [], seconds
    a, b = set(left), set(right)
    return len(left), [f"rows {len(left)} != {len(right)}", f"only Spark: {sorted(a - b)[:3]}",
                       f"only SQL: {sorted(b - a)[:3]}"], seconds


def main():
    from conftest import local_session
    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or [name for name in queries() if name in oracle_sql()]
    spark, base = local_session(), database(sf_dir)
    failed = 0
    for name in wanted:
        try:
            rows, problems, seconds = check(
                spark, base, sf_dir, name, queries()[name], oracle_sql()[name])
        except Exception as error:
            rows, problems, seconds = -1, [repr(error)[:1500]], 0
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name:28s} {rows:8d} rows {seconds:6.2f} s")
        for problem in problems:
            print("     ", problem)
    print(f"{len(wanted) - failed} of {len(wanted)} equal")
    sys.exit(failed > 0)


if __name__ == "__main__":
    main()
