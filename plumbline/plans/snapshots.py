"""Price history of the cost library."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plumbline import fixed_values as fixed
from plumbline.functions import percent, tier_below
from plumbline.operators import history as scd
from plumbline.operators.salting import HotKeys

KEY = "cost_code"
# Only a change of these opens a new version; a new unit or date alone does not.
CHECKED = ["unit_cost_low", "unit_cost_mid", "unit_cost_high"]


def snapshot_rows(raw_costs: DataFrame) -> DataFrame:
    """Tracked columns, taken from the raw table and not from staging."""
    return raw_costs.select(
        "cost_code", "division", "division_name", "item_type", "uom", *CHECKED,
        tier_below(F.col("unit_cost_mid"), fixed.COST_TIERS_BELOW, fixed.COST_TIER_REST).alias(
            "cost_tier"
        ),
        "last_updated",
    )


def initial(raw_costs: DataFrame, run_time: str) -> DataFrame:
    return scd.initial_history(snapshot_rows(raw_costs), KEY, run_time)


def merged(history: DataFrame, raw_costs: DataFrame, run_time: str) -> DataFrame:
    return scd.merge_history(history, snapshot_rows(raw_costs), KEY, CHECKED, run_time)


def merged_open(open_rows: DataFrame, raw_costs: DataFrame, run_time: str) -> DataFrame:
    return scd.merge_open(open_rows, snapshot_rows(raw_costs), KEY, CHECKED, run_time)


def priced_as_of(takeoffs: DataFrame, history: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Staged takeoffs with the unit costs valid when they were created; ``hot`` has codes with very many."""
    rows = scd.as_of(
        takeoffs.select("takeoff_id", "cost_code", "quantity", "created_at"),
        history, KEY, "created_at", ["scd_id", *CHECKED], hot,
    )
    return rows.withColumn(
        "extended_cost_mid", F.col("quantity").cast("double") * F.col("unit_cost_mid")
    )


def price_changes(history: DataFrame) -> DataFrame:
    """Mid price of every version with its change from the version before."""
    previous = F.col("previous_unit_cost_mid")
    return scd.changes(history, KEY, "unit_cost_mid").select(
        "cost_code",
        "version_number",
        "valid_from",
        "valid_to",
        "unit_cost_mid",
        previous,
        percent(F.col("unit_cost_mid") - previous, previous, 2).alias("change_pct"),
    )
