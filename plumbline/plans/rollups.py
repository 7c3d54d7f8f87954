"""Roll-ups that produce estimates and line items from takeoffs, and business keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plumbline import fixed_values as fixed
from plumbline.functions import round_half_away
from plumbline.operators.salting import HOT_ROWS, HotKeys, Save, grid_join, salted_join


def quantities_by_project_and_code(takeoffs: DataFrame) -> DataFrame:
    """Quantity per project and cost code; the sum is exact, so later pricing is too."""
    return takeoffs.groupBy("project_id", "cost_code").agg(
        F.sum("quantity").alias("quantity"),
        F.min("item_type").alias("item_type"),
        F.min("uom").alias("uom"),
    )


def estimate_rollup(
    versions: DataFrame,
    takeoffs: DataFrame,
    costs: DataFrame,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Low, mid and high total of every estimate version from its project's takeoffs.

    ``versions`` has estimate_id, project_id, estimate_version and
    ``version_rate``; version v scales the totals by ``1 + (v - 1) * rate``.
    Codes without a price are left out and a project without takeoffs totals 0.
    Quantities are summed per project and code before they meet the prices, so
    a hot code is one row per project by then. ``hot`` has the projects with
    very many versions.
    """
    quantities = takeoffs.groupBy("project_id", "cost_code").agg(F.sum("quantity").alias("quantity"))
    priced = quantities.join(
        costs.select("cost_code", "unit_cost_low", "unit_cost_mid", "unit_cost_high"), "cost_code"
    )
    totals = priced.groupBy("project_id").agg(
        *[
            F.sum(F.col("quantity") * F.col(f"unit_cost_{level}")).cast("double").alias(level)
            for level in ("low", "mid", "high")
        ]
    )
    factor = F.lit(1.0) + (F.col("estimate_version") - 1).cast("double") * F.col("version_rate")

    def scaled(level: str, spread: float | None = None) -> Column:
        value = F.coalesce(F.col(level), F.lit(0.0)) * factor
        return round_half_away(value if spread is None else value * F.lit(spread), 2)

    return salted_join(
        versions, totals, "project_id", F.col("estimate_id"), how="left", hot=hot
    ).select(
        "estimate_id",
        "project_id",
        "estimate_version",
        scaled("low", fixed.LOW_TOTAL_FACTOR).alias("estimate_total_low"),
        scaled("mid").alias("estimate_total_mid"),
        scaled("high", fixed.HIGH_TOTAL_FACTOR).alias("estimate_total_high"),
    )


def estimate_line_item_rollup(
    estimates: DataFrame, takeoffs: DataFrame, costs: DataFrame, save: Save, cell_rows: int = HOT_ROWS
) -> DataFrame:
    """Priced line items, one per estimate and cost code of its project.

    The versions of a project share the same items, so the result has one copy
    of them per estimate. A project with many estimates and many codes is cut on
    both sides; ``estimates`` needs ``estimate_id`` and ``project_id`` alone.
    The priced quantities, which are read twice, are stored.
    """
    priced = quantities_by_project_and_code(takeoffs).join(
        costs.select("cost_code", "unit_cost_mid"), "cost_code"
    )
    priced, _ = save("priced_quantities", priced, {})
    return grid_join(
        estimates.select("estimate_id", "project_id"),
        priced,
        "project_id",
        F.col("estimate_id"),
        F.col("cost_code"),
        save,
        "crowded_projects",
        cell_rows,
    ).select(
        "estimate_id",
        "cost_code",
        "item_type",
        F.round("quantity", 2).alias("quantity"),
        "uom",
        "unit_cost_mid",
        F.round(F.col("quantity") * F.col("unit_cost_mid"), 2).alias("extended_cost_mid"),
    )


def cost_code_key(division: Column, item_type: Column) -> Column:
    """``03`` and ``footing`` give ``03-FOOT``."""
    return F.concat_ws("-", division, F.upper(F.substring(item_type, 1, 4)))


def sheet_key(discipline: Column, sheet: Column) -> Column:
    """``A`` and 7 give ``A07``; longer numbers keep all their digits."""
    return F.format_string("%s%02d", discipline, sheet)
