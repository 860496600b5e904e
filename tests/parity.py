"""Compare registered queries with their reference SQL: `python tests/parity.py [sf_dir] [name ...]`."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TYPE_NAMES = {"int32": "int", "int64": "long", "double": "double", "string": "string", "large_string": "string",
              "date32[day]": "date", "bool": "bool"}


def _normal(table):
    """Column -> type, and the rows in one order, columns in name order."""
    names = sorted(table.column_names)
    kinds = {n: TYPE_NAMES.get(str(table.schema.field(n).type), str(table.schema.field(n).type)) for n in names}
    table = table.select(names)
    for i, n in enumerate(names):
        if kinds[n] == "string":
            table = table.set_column(i, n, table.column(n).cast("string"))
    return kinds, table.sort_by([(n, "ascending") for n in names if str(table.schema.field(n).type) != "null"])


def connect(sf_dir: str):
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return db


def difference(spark, db, sf_dir: str, query, sql: str) -> str | None:
    """None when the query equals its SQL in names, types and every value."""
    kinds, got = _normal(query(spark, sf_dir).toArrow())
    want_kinds, want = _normal(db.execute(sql).to_arrow_table())
    if list(kinds) != list(want_kinds):
        return f"columns {sorted(set(kinds) ^ set(want_kinds))}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    kinds_off = {n: (kinds[n], want_kinds[n]) for n in kinds if kinds[n] != want_kinds[n]}
    if not kinds_off and got.equals(want.cast(got.schema)):
        return None
    got, want = got.to_pylist(), want.to_pylist()
    differing = [(g, w) for g, w in zip(got, want) if g != w]
    first = [(n, differing[0][0][n], differing[0][1][n]) for n in kinds if differing and differing[0][0][n] != differing[0][1][n]]
    if not differing and not kinds_off:
        return None
    return f"{len(differing)} of {len(got)} rows differ, first {first[:4]} types {kinds_off}"


def main() -> None:
    from salescube.catalog.registry import ORACLES, QUERIES
    from salescube.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        master="local[8]",
        **{"spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, db, sf_dir, QUERIES[name], ORACLES[name])
        except Exception as err:  # report and go on with the next query
            problem = f"{type(err).__name__}: {str(err)[:600]}"
        bad += problem is not None
        print(f"{name:28} {time.time() - start:6.1f}s  {problem or 'equal'}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")


if __name__ == "__main__":
    main()
