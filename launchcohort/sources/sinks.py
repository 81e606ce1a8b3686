"""Result files. For result tables of a few rows: each is written as one file."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(result: DataFrame, folder: str) -> None:
    result.coalesce(1).write.mode("overwrite").option("header", True).csv(folder)


def write_json(result: DataFrame, folder: str) -> None:
    result.coalesce(1).write.mode("overwrite").json(folder)


def write_results(tables: dict[str, DataFrame], folder: str) -> None:
    """Every table as csv and as JSON lines under `folder`."""
    for name, table in tables.items():
        write_csv(table, f"{folder}/{name}_csv")
        write_json(table, f"{folder}/{name}_json")
