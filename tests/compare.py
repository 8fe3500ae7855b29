"""Run registered queries against their SQL counterpart in DuckDB.

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def rows_of(frame) -> tuple[list[str], list[tuple]]:
    """Columns sorted by name, rows sorted by text."""
    columns = sorted(frame.column_names)
    rows = list(zip(*[frame[c].to_pylist() for c in columns], strict=True))
    return columns, sorted(rows, key=repr)


def difference(spark_df, relation) -> str | None:
    """What differs between a Spark result and a DuckDB result, None if nothing does."""
    got_frame, want_frame = spark_df.toArrow(), relation.to_arrow_table()
    (got_columns, got), (want_columns, want) = rows_of(got_frame), rows_of(want_frame)
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    for c in got_columns:
        a, b = got_frame.schema.field(c).type, want_frame.schema.field(c).type
        if a != b:
            return f"type of {c}: {a} != {b}"
    if not got:
        return "no rows"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want, strict=True):
        if a != b:
            return f"{a} != {b}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tripweave.session import clear_staged, local_session

    QUERIES, ORACLES = queries(), oracle_sql()

    sf_dir, *names = sys.argv[1:]
    spark = local_session("compare")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        df = QUERIES[name](spark, sf_dir)
        if name in ORACLES:
            problem = difference(df, con.sql(ORACLES[name]))
            status = problem or "ok"
            bad += problem is not None
        else:
            status = f"rows only: {df.count()}"
        print(f"{name:26s} {time.time() - start:6.2f}s  {status[:600]}", flush=True)
        clear_staged(spark)
    print("differences:", bad)


if __name__ == "__main__":
    main()
