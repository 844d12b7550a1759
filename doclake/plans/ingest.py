"""CSV files to catalog tables."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import SparkSession

from doclake.constants import CSV_TABLES
from doclake.operators.cleaning import typed_clean
from doclake.operators.tables import write_table
from doclake.sources.tables import scan_csv


def ingest_tables(
    spark: SparkSession,
    folder: str,
    warehouse: str,
    database: str,
    schemas: Mapping[str, str],
    tables: Mapping[str, tuple[str, Sequence[str]]] = CSV_TABLES,
    multi_line: Collection[str] = ("order_reviews",),
) -> dict[str, int]:
    """Read, clean and store each CSV of ``tables``; returns rows per table.

    ``schemas`` give column types by table name. ``multi_line`` names the tables
    with line breaks in quoted fields, whose files can't be split.
    """
    root = f"{warehouse.rstrip('/')}/{database}.db"
    rows = {}
    for table, (file, timestamp_cols) in tables.items():
        raw = scan_csv(spark, f"{folder}/{file}", schemas[table], table in multi_line)
        rows[table] = write_table(
            typed_clean(raw, timestamp_cols), f"{database}.{table}", f"{root}/{table}", root
        )
    return rows
