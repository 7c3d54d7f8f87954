"""Staging: one typed, labelled row per raw row.

Every function adds or replaces columns in a single projection, so each
expression sees the *raw* columns: tiers are taken from the raw double, not
from the rounded decimal that replaces it, and the discipline name from the
discipline as delivered. Columns a caller left out of the raw frame stay out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plumbline import fixed_values as fixed
from plumbline.functions import label, nullif_zero, round_half_away, tier_below, tier_from, to_decimal

LOADED_AT = "_loaded_at"


def _timestamp(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz")


def _spread_pct(high: str, low: str, mid: str) -> Column:
    ratio = (F.col(high) - F.col(low)) / nullif_zero(F.col(mid))
    return round_half_away(ratio * F.lit(100.0), 2)


def stg_projects(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "location_state": F.upper("location_state"),
            "bid_date": F.col("bid_date").cast("date"),
            "project_type_display": label(
                F.col("project_type"), fixed.PROJECT_TYPE_LABELS, fixed.PROJECT_TYPE_OTHER
            ),
            "created_at": _timestamp("created_at"),
            LOADED_AT: F.current_timestamp(),
        }
    ).withColumnRenamed("status", "project_status")


def stg_blueprint_pages(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "discipline": F.upper("discipline"),
            "discipline_name": label(
                F.col("discipline"), fixed.DISCIPLINE_LABELS, fixed.DISCIPLINE_OTHER
            ),
            "created_at": _timestamp("created_at"),
            LOADED_AT: F.current_timestamp(),
        }
    )


def stg_cost_library(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "unit_cost_low": to_decimal(F.col("unit_cost_low"), 12, 2),
            "unit_cost_mid": to_decimal(F.col("unit_cost_mid"), 12, 2),
            "unit_cost_high": to_decimal(F.col("unit_cost_high"), 12, 2),
            "cost_variance_pct": _spread_pct("unit_cost_high", "unit_cost_low", "unit_cost_mid"),
            "cost_tier": tier_below(
                F.col("unit_cost_mid"), fixed.COST_TIERS_BELOW, fixed.COST_TIER_REST
            ),
            "last_updated": F.col("last_updated").cast("date"),
            LOADED_AT: F.current_timestamp(),
        }
    )


def stg_takeoff_items(raw: DataFrame) -> DataFrame:
    confidence = F.col("confidence")
    return raw.withColumns(
        {
            "quantity": to_decimal(F.col("quantity"), 12, 2),
            "confidence": to_decimal(confidence, 5, 3),
            "confidence_tier": tier_from(
                confidence, fixed.CONFIDENCE_TIERS_FROM, fixed.CONFIDENCE_TIER_REST
            ),
            "is_low_confidence": F.coalesce(confidence < fixed.LOW_CONFIDENCE, F.lit(False)),
            "extraction_method_display": label(
                F.col("extraction_method"), fixed.EXTRACTION_METHOD_LABELS, fixed.METHOD_OTHER
            ),
            "created_at": _timestamp("created_at"),
            LOADED_AT: F.current_timestamp(),
        }
    )


def stg_estimates(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "estimate_total_low": to_decimal(F.col("estimate_total_low"), 14, 2),
            "estimate_total_mid": to_decimal(F.col("estimate_total_mid"), 14, 2),
            "estimate_total_high": to_decimal(F.col("estimate_total_high"), 14, 2),
            "estimate_range_pct": _spread_pct(
                "estimate_total_high", "estimate_total_low", "estimate_total_mid"
            ),
            "estimate_size": tier_below(
                F.col("estimate_total_mid"), fixed.ESTIMATE_SIZES_BELOW, fixed.ESTIMATE_SIZE_REST
            ),
            "estimation_method_display": label(
                F.col("estimation_method"), fixed.ESTIMATION_METHOD_LABELS, fixed.METHOD_OTHER
            ),
            "generated_at": _timestamp("generated_at"),
            LOADED_AT: F.current_timestamp(),
        }
    )


def stg_estimate_line_items(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "quantity": to_decimal(F.col("quantity"), 12, 2),
            "unit_cost_mid": to_decimal(F.col("unit_cost_mid"), 12, 2),
            "extended_cost_mid": to_decimal(F.col("extended_cost_mid"), 14, 2),
            "cost_impact": tier_below(
                F.col("extended_cost_mid"), fixed.COST_IMPACTS_BELOW, fixed.COST_IMPACT_REST
            ),
            LOADED_AT: F.current_timestamp(),
        }
    )


def stg_qa_reviews(raw: DataFrame) -> DataFrame:
    severity = F.col("severity")
    return raw.withColumns(
        {
            "issue_type_display": label(F.col("issue_type"), fixed.ISSUE_LABELS, fixed.ISSUE_OTHER),
            "severity_score": label(severity, fixed.SEVERITY_SCORES, fixed.SEVERITY_OTHER),
            "is_critical": F.coalesce(severity.isin(fixed.CRITICAL_SEVERITIES), F.lit(False)),
            "status": F.when(F.col("resolved"), F.lit("Resolved")).otherwise(F.lit("Open")),
            "reviewed_at": _timestamp("reviewed_at"),
            LOADED_AT: F.current_timestamp(),
        }
    )
