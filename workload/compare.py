"""Run a query and its SQL and compare rows, used by the tests and by hand."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from workload.oracle import all_sql
from workload.queries import all_queries


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)

    def plain(value):
        if value is None or value is pd.NA or value != value:
            return None
        return value.item() if hasattr(value, "item") else value

    rows = [tuple(plain(v) for v in row) for row in frame[columns].itertuples(index=False)]
    return sorted(rows, key=lambda row: [(v is not None, str(type(v)), v) for v in row])


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def differences(spark: SparkSession, con, sf_dir: str, name: str) -> list[str]:
    """What differs; empty when columns, row count and every value agree."""
    frame = all_queries()[name](spark, sf_dir)
    ours = frame.toPandas()
    result = con.execute(all_sql()[name])
    types = {column[0]: str(column[1]) for column in result.description}
    theirs = result.df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return [f"columns {sorted(ours.columns)} / {sorted(theirs.columns)}"]
    wanted = {column: TYPES.get(dtype, dtype) for column, dtype in frame.dtypes}
    if wanted != types:
        return [f"types {wanted} / {types}"]
    mine, other = _rows(ours), _rows(theirs)
    if len(mine) != len(other):
        return [f"rows {len(mine)} / {len(other)}"]
    if not mine:
        return ["no rows on either side"]
    return [f"{a} / {b}" for a, b in zip(mine, other, strict=True) if a != b][:5]
