"""Run a query and its checking SQL on the same files and compare the rows."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of text, with columns in name order."""
    frame = frame[sorted(frame.columns)]

    def text(value) -> str:
        if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
            return "<null>"
        if isinstance(value, pd.Timestamp):
            return value.date().isoformat() if value == value.normalize() else value.isoformat()
        if hasattr(value, "isoformat"):
            return value.isoformat()
        if isinstance(value, float) or type(value).__name__.startswith("float"):
            # A column of whole numbers with nulls is one of floats in pandas.
            return str(int(value)) if float(value).is_integer() else repr(float(value))
        if isinstance(value, bool) or type(value).__name__ == "bool_":
            return str(bool(value))
        return str(value)

    return sorted(tuple(text(v) for v in row) for row in frame.astype(object).itertuples(index=False))


def compare(spark_frame: pd.DataFrame, oracle_frame: pd.DataFrame) -> str | None:
    """None if both hold the same rows, else what differs first."""
    if sorted(spark_frame.columns) != sorted(oracle_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(oracle_frame.columns)}"
    left, right = canonical(spark_frame), canonical(oracle_frame)
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"{a} != {b}"
    return None
