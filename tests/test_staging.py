"""Edge rows of the staging jobs."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import by, table

from plumbline.functions import avg_decimal, round_half_away, to_decimal
from plumbline.plans import staging


def test_confidence_tier_comes_from_the_raw_value(spark):
    raw = table(
        spark, "takeoff_items",
        *[dict(confidence=value) for value in (0.5996, 0.60, 0.75, 0.90, None, -0.1, 1.2)],
    )
    rows = by(staging.stg_takeoff_items(raw), "takeoff_id")
    assert rows[1]["confidence"] == Decimal("0.600")
    assert [rows[n]["confidence_tier"] for n in range(1, 8)] == [
        "Very Low", "Low", "Medium", "High", "Very Low", "Very Low", "High",
    ]
    assert [rows[n]["is_low_confidence"] for n in range(1, 8)] == [
        True, False, False, False, False, True, False,
    ]


def test_quantity_rounds_the_binary_value(spark):
    rows = by(staging.stg_takeoff_items(table(spark, "takeoff_items", dict(quantity=1.005))), "takeoff_id")
    assert rows[1]["quantity"] == Decimal("1.00")


def test_cost_tiers_and_spread(spark):
    raw = table(
        spark, "cost_library",
        *[
            dict(cost_code=str(number), unit_cost_mid=mid)
            for number, mid in enumerate((49.999, 50.0, 200.0, None, 0.0))
        ],
    )
    rows = by(staging.stg_cost_library(raw), "cost_code")
    assert [rows[str(n)]["cost_tier"] for n in range(5)] == [
        "Low Cost", "Medium Cost", "High Cost", "High Cost", "Low Cost",
    ]
    assert rows["0"]["unit_cost_mid"] == Decimal("50.00")
    assert rows["1"]["cost_variance_pct"] == 120.0
    assert rows["3"]["cost_variance_pct"] is None and rows["4"]["cost_variance_pct"] is None


def test_line_item_impact(spark):
    raw = table(
        spark, "estimate_line_items",
        *[dict(extended_cost_mid=value) for value in (999.99, 1000.0, 10000.0, 50000.0, None)],
    )
    rows = by(staging.stg_estimate_line_items(raw), "line_item_id")
    assert [rows[n]["cost_impact"] for n in range(1, 6)] == [
        "Minor", "Moderate", "Significant", "Major", "Major",
    ]


def test_estimate_size(spark):
    totals = (0.0, 100000.0, 500000.0, 2000000.0, None)
    raw = table(spark, "estimates", *[dict(estimate_total_mid=total) for total in totals])
    rows = by(staging.stg_estimates(raw), "estimate_id")
    assert [rows[n]["estimate_size"] for n in range(1, 6)] == [
        "Small", "Medium", "Large", "Enterprise", "Enterprise",
    ]
    assert rows[1]["estimate_range_pct"] is None


def test_discipline_name_comes_from_the_raw_case(spark):
    raw = table(spark, "blueprint_pages", *[dict(discipline=mark) for mark in ("a", "Z", "M")])
    rows = by(staging.stg_blueprint_pages(raw), "page_id")
    assert [(rows[n]["discipline"], rows[n]["discipline_name"]) for n in (1, 2, 3)] == [
        ("A", "Unknown"), ("Z", "Unknown"), ("M", "Mechanical"),
    ]


def test_reviews(spark):
    raw = table(
        spark, "qa_reviews",
        dict(issue_type="wrong_uom", severity="critical"),
        dict(issue_type="zzz", severity="zzz", resolved=None),
        dict(issue_type=None, severity=None, resolved=False),
    )
    rows = by(staging.stg_qa_reviews(raw), "review_id")
    assert [rows[n]["issue_type_display"] for n in (1, 2, 3)] == [
        "Wrong Unit of Measure", "Other", "Other",
    ]
    assert [rows[n]["severity_score"] for n in (1, 2, 3)] == [4, 0, 0]
    assert [rows[n]["is_critical"] for n in (1, 2, 3)] == [True, False, False]
    assert [rows[n]["status"] for n in (1, 2, 3)] == ["Resolved", "Open", "Open"]


def test_projects(spark):
    raw = table(
        spark, "projects", dict(project_type="mixed_use", status="on_hold"), dict(project_type="barn")
    )
    rows = by(staging.stg_projects(raw), "project_id")
    assert rows[1]["location_state"] == "CA" and rows[1]["project_status"] == "on_hold"
    assert [rows[n]["project_type_display"] for n in (1, 2)] == ["Mixed Use", "Other"]


@pytest.mark.parametrize(
    ("value", "places", "expected"),
    [(1.005, 2, 1.0), (0.285, 2, 0.28), (2.5, 0, 3.0), (-2.5, 0, -3.0), (0.125, 2, 0.13)],
)
def test_round_half_away(spark, value, places, expected):
    row = spark.range(1).select(
        round_half_away(F.lit(value), places).alias("rounded"),
        to_decimal(F.lit(value), 12, places).cast("double").alias("fixed"),
    ).first()
    assert row["rounded"] == expected and row["fixed"] == expected


def test_average_of_decimals(spark):
    frame = spark.createDataFrame([("0.1",), ("0.2",), (None,)], "text string")
    value = F.col("text").cast("decimal(5,3)")
    assert frame.agg(avg_decimal(value, 3)).first()[0] == 0.15
    assert frame.where("false").agg(avg_decimal(value, 3)).first()[0] is None
