"""Run registered queries next to their oracle SQL and compare type, row count and values.

Usage: python tests/compare.py [sf] [name-part ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pyarrow as pa

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(kind: pa.DataType) -> str:
    text = str(kind)
    return {"large_string": "string", "date32[day]": "date"}.get(text, text)


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    return sorted(zip(*[table.column(n).to_pylist() for n in names]), key=repr)


def difference(actual: pa.Table, expected: pa.Table) -> str | None:
    shape = {f.name: _plain(f.type) for f in actual.schema}, {f.name: _plain(f.type) for f in expected.schema}
    if shape[0] != shape[1]:
        return f"schema {shape[0]} != {shape[1]}"
    if actual.num_rows != expected.num_rows:
        return f"{actual.num_rows} rows != {expected.num_rows}"
    for a, b in zip(_rows(actual), _rows(expected)):
        if a != b:
            return f"{a} != {b}"
    return None


def main() -> None:
    from clickfolk.catalog.registry import all_queries
    from clickfolk.session import build_session

    sf, parts = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                                  "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, query in all_queries().items():
        if parts and not any(name.startswith(p) or p in name for p in parts):
            continue
        start = time.time()
        try:
            table = query.run(spark, sf_dir).toArrow()
            problem = difference(table, con.execute(query.sql).to_arrow_table()) if query.sql else None
            state = "FAIL " + problem if problem else ("ok" if query.sql else "rows")
            detail = f"{table.num_rows} rows"
        except Exception as error:  # report and go on with the next query
            state, detail = "ERROR " + str(error)[:1500], ""
        bad += state[0] in "FE"
        print(f"{name:32s} {time.time() - start:6.2f}s {detail:12s} {state}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
