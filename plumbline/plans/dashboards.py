"""Dashboard queries over the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plumbline import fixed_values as fixed
from plumbline.functions import (
    avg_decimal,
    conditional_count,
    label,
    percent,
    round_half_away,
    tier_from,
)
from plumbline.plans.reports import readiness as _readiness


def _millions(value: Column, places: int) -> Column:
    return round_half_away(value.cast("double") / F.lit(1000000.0), places)


def portfolio(dashboard: DataFrame) -> DataFrame:
    """Totals over the projects with a priced estimate."""
    return dashboard.where(F.col("estimate_total_mid") > 0).agg(
        F.count("*").alias("total_projects"),
        _millions(F.sum("estimate_total_mid"), 1).alias("portfolio_value_millions"),
        round_half_away(avg_decimal(F.col("avg_confidence").cast("decimal(5,3)"), 3), 3).alias(
            "avg_ai_confidence"
        ),
        F.sum("takeoff_count").alias("total_takeoffs"),
    )


def attention_projects(dashboard: DataFrame, size: int = 5) -> DataFrame:
    """Largest projects that need review or have open issues; equal totals by project id."""
    flagged = (F.col("readiness_status") == "Needs Review") | (
        F.col("open_qa_issues") > fixed.DASHBOARD_OPEN_ISSUES
    )
    return (
        dashboard.where(flagged)
        .orderBy(F.desc_nulls_last("estimate_total_mid"), "project_id")
        .limit(size)
        .select(
            "project_name",
            _millions(F.col("estimate_total_mid"), 2).alias("estimate_millions"),
            round_half_away(F.col("avg_confidence"), 2).alias("confidence"),
            "open_qa_issues",
            "readiness_status",
        )
    )


def cost_drivers(takeoffs: DataFrame, size: int = 5) -> DataFrame:
    """Division and item pairs by extended cost, ordered by the unrounded sum."""
    return (
        takeoffs.groupBy("division_name", "item_type")
        .agg(F.count("*").alias("occurrences"), F.sum("extended_cost_mid").alias("total"))
        .orderBy(F.desc_nulls_last("total"), "division_name", "item_type")
        .limit(size)
        .select(
            "division_name",
            "item_type",
            "occurrences",
            _millions(F.col("total"), 2).alias("total_cost_millions"),
        )
    )


def extraction_performance(takeoffs: DataFrame) -> DataFrame:
    """Confidence by discipline, with its display band."""
    by_discipline = takeoffs.groupBy("discipline_name").agg(
        F.count("*").alias("takeoffs"),
        round_half_away(avg_decimal(F.col("confidence"), 3), 3).alias("avg_confidence"),
        conditional_count(F.col("is_low_confidence")).alias("low"),
    )
    return by_discipline.select(
        "discipline_name",
        "takeoffs",
        "avg_confidence",
        percent(F.col("low"), F.col("takeoffs"), 1).alias("pct_needs_review"),
        tier_from(
            F.col("avg_confidence"), fixed.CONFIDENCE_BANDS_FROM, fixed.CONFIDENCE_BAND_REST
        ).alias("confidence_band"),
    ).orderBy(F.desc_nulls_last("avg_confidence"), "discipline_name")


def readiness(dashboard: DataFrame) -> DataFrame:
    return _readiness(dashboard, name="count")


def recent_activity(estimates: DataFrame, projects: DataFrame, size: int = 4) -> DataFrame:
    """Latest estimates with the name of their project.

    ``fct_estimates`` holds known projects only, so the limit may come before
    the join and the join sees four rows.
    """
    latest = (
        estimates.orderBy(F.desc_nulls_last("generated_at"), "estimate_id")
        .limit(size)
        .select("estimate_id", "project_id", "estimation_method", "generated_at")
    )
    return (
        latest.join(projects.select("project_id", "project_name"), "project_id")
        .orderBy(F.desc_nulls_last("generated_at"), "estimate_id")
        .select(
            "project_name",
            "estimation_method",
            F.col("generated_at").cast("date").alias("activity_date"),
            label(F.col("estimation_method"), fixed.ACTIVITY_LABELS, fixed.ACTIVITY_OTHER).alias(
                "method_label"
            ),
        )
    )
