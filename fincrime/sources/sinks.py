"""Result output.  A report is a DataFrame; writing it is the caller's choice."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_report(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                 partition_by: list[str] | None = None) -> None:
    """Write a report distributed (one file per task, no driver collect).

    ``fmt`` is any Spark writer format (parquet, csv, json, orc).  CSV gets a
    header so the consumer's spreadsheet tool reads the column names.
    """
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
