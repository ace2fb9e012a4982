"""Running a registered query and its SQL side by side."""

import os

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def comparable(table):
    """Columns by name, rows in an order of their own values."""
    if isinstance(table, pa.RecordBatchReader):
        table = table.read_all()
    table = table.select(sorted(table.column_names))
    return table.sort_by([(name, "ascending") for name in table.column_names])


def rows(table):
    return list(zip(*(column.to_pylist() for column in table.columns)))
