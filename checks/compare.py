"""Run queries and their SQL side by side: ``python -m checks.compare <sf_dir> [query ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
import pyarrow as pa

from checks.oracles import ORACLES
from checks.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _types(schema: pa.Schema) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in schema}


def _rows(table: pa.Table) -> Counter:
    names = sorted(table.column_names)
    return Counter(zip(*[table.column(n).to_pylist() for n in names])) if table.num_rows else Counter()


def compare(spark, con, sf_dir: str, name: str) -> str:
    """``ok`` and the row count, or what differs."""
    start = time.time()
    mine = QUERIES[name](spark, sf_dir).toArrow()
    took = time.time() - start
    if name not in ORACLES:
        return f"ok rows={mine.num_rows} spark={took:.1f}s (no SQL)"
    start = time.time()
    theirs = con.sql(ORACLES[name]).to_arrow_table()
    sql_took = time.time() - start
    if _types(mine.schema) != _types(theirs.schema):
        return f"TYPES {_types(mine.schema)} != {_types(theirs.schema)}"
    a, b = _rows(mine), _rows(theirs)
    if a != b:
        return f"VALUES {mine.num_rows} vs {theirs.num_rows}; only spark {list((a - b).items())[:2]}; only sql {list((b - a).items())[:2]}"
    return f"ok rows={mine.num_rows} spark={took:.1f}s sql={sql_took:.1f}s"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    folder, chosen = sys.argv[1], sys.argv[2:] or list(QUERIES)
    connection = connect(folder)
    for query_name in chosen:
        try:
            print(query_name, compare(session, connection, folder, query_name)[:1500], flush=True)
        except Exception as e:
            print(query_name, "FAILED", type(e).__name__, str(e)[:1200], flush=True)
