"""Raw tables as CSV lines of which some do not fit, to show what a load does with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.sources.raw_csv import as_lines


def _spoilt(rows: DataFrame, column: str, where: Column, text: str) -> DataFrame:
    return rows.withColumn(column, F.when(where, F.lit(text)).otherwise(F.col(column).cast("string")))


def _projects(rows: DataFrame) -> DataFrame:
    """Lines that end after three fields."""
    lines = as_lines(rows, "projects")
    short = F.substring_index("line", ",", 3)
    return lines.withColumn("line", F.when(F.col("project_id") % 13 == 0, short).otherwise(F.col("line")))


def _cost_library(rows: DataFrame) -> DataFrame:
    """Prices and dates that are none, some in one line."""
    number = F.substring("cost_code", 2, 20).cast("bigint")
    rows = _spoilt(rows, "unit_cost_mid", number % 7 == 0, "n/a")
    return as_lines(_spoilt(rows, "last_updated", number % 11 == 0, "2024-13-45"), "cost_library")


def _takeoff_items(rows: DataFrame) -> DataFrame:
    """Quantities in words."""
    return as_lines(_spoilt(rows, "quantity", F.col("page_id") % 17 == 0, "twelve"), "takeoff_items")


DAMAGED = {"projects": _projects, "cost_library": _cost_library, "takeoff_items": _takeoff_items}
