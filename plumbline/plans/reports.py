"""Report metrics. Each takes stored or lazy tables and returns a small frame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline import fixed_values as fixed
from plumbline.functions import avg_decimal, conditional_count, round_half_away
from plumbline.operators.value_histogram import ValueHistogram


def _share_pct(part: Column, whole: Column) -> Column:
    share = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)) * F.lit(100.0)
    return F.coalesce(round_half_away(share, 1), F.lit(0.0))


def _beside(*frames: DataFrame) -> DataFrame:
    """One row from several one-row frames with different columns."""
    stacked = reduce(lambda one, two: one.unionByName(two, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


def counts(projects: DataFrame, pages: DataFrame) -> DataFrame:
    return _beside(
        projects.agg(F.count("*").alias("project_count")),
        pages.agg(F.count("*").alias("page_count")),
    )


def pages_by_discipline(pages: DataFrame) -> DataFrame:
    return (
        pages.groupBy("discipline", "discipline_name")
        .agg(F.count("*").alias("page_count"))
        .orderBy(F.desc("page_count"), F.asc_nulls_last("discipline"), "discipline_name")
    )


def takeoff_stats(takeoffs: DataFrame) -> DataFrame:
    """Counts by method and confidence of ``fct_takeoffs``; low is taken from the rounded value."""
    method, confidence = F.col("extraction_method"), F.col("confidence")
    low = confidence < F.lit(str(fixed.LOW_CONFIDENCE)).cast("decimal(5,3)")
    totals = takeoffs.agg(
        F.count("*").alias("total_takeoffs"),
        conditional_count(method == "ai").alias("ai_takeoffs"),
        conditional_count(method == "manual").alias("manual_takeoffs"),
        conditional_count(method == "hybrid").alias("hybrid_takeoffs"),
        F.coalesce(round_half_away(avg_decimal(confidence, 3), 3), F.lit(0.0)).alias(
            "avg_confidence"
        ),
        conditional_count(low).alias("low_confidence_count"),
    )
    total = F.col("total_takeoffs")
    return totals.withColumns(
        {
            "pct_ai": _share_pct(F.col("ai_takeoffs"), total),
            "pct_low_confidence": _share_pct(F.col("low_confidence_count"), total),
        }
    )


def estimate_stats(totals: ValueHistogram) -> DataFrame:
    """Number, sum, mean and percentiles, all from the histogram of the estimates' mid totals."""
    quantiles = totals.percentiles({"p50_mid": 0.5, "p90_mid": 0.9})
    return quantiles.select(
        F.lit(totals.rows).cast("bigint").alias("total_estimates"),
        F.lit(totals.total()).alias("sum_mid"),
        F.coalesce(round_half_away(F.lit(totals.mean()).cast("double"), 2), F.lit(0.0)).alias("avg_mid"),
        *[F.coalesce(round_half_away(F.col(name), 4), F.lit(0.0)).alias(name) for name in quantiles.columns],
    )


def top_cost_codes(takeoffs: DataFrame, size: int = 10) -> DataFrame:
    """Cost codes with the highest extended cost, ranked; equal totals by code."""
    order = [F.desc_nulls_last("total_extended_cost"), F.asc("cost_code"), F.asc("item_type")]
    top = (
        takeoffs.groupBy("cost_code", "division_name", "item_type")
        .agg(
            F.sum("extended_cost_mid").alias("total_extended_cost"),
            F.count("*").alias("takeoff_count"),
        )
        .orderBy(*order)
        .limit(size)
    )
    # The window is over the limited rows alone.
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def qa_stats(reviews: DataFrame, projects: DataFrame) -> DataFrame:
    totals = _beside(
        reviews.agg(
            F.count("*").alias("total_issues"),
            conditional_count(~F.col("resolved")).alias("open_issues"),
            conditional_count(F.col("is_critical")).alias("critical_issues"),
        ),
        projects.agg(F.count("*").alias("project_count")),
    )
    rate = F.col("total_issues").cast("double") / F.nullif(
        F.col("project_count").cast("double"), F.lit(0.0)
    )
    return totals.withColumn(
        "issues_per_project", F.coalesce(round_half_away(rate, 2), F.lit(0.0))
    ).drop("project_count")


def readiness(dashboard: DataFrame, name: str = "project_count") -> DataFrame:
    return (
        dashboard.groupBy("readiness_status")
        .agg(F.count("*").alias(name))
        .orderBy(F.desc(name), "readiness_status")
    )


def top_divisions_by_cost(takeoffs: DataFrame, size: int = 5) -> DataFrame:
    """Documented ad-hoc query: cost codes by total extended cost."""
    return (
        takeoffs.groupBy("cost_code", "division_name")
        .agg(F.sum("extended_cost_mid").alias("total_cost"))
        .orderBy(F.desc_nulls_last("total_cost"), "cost_code", "division_name")
        .limit(size)
    )


def readiness_summary(dashboard: DataFrame) -> DataFrame:
    """Documented ad-hoc query: projects and their mean confidence per readiness status."""
    confidence = F.col("avg_confidence").cast("decimal(5,3)")
    return (
        dashboard.groupBy("readiness_status")
        .agg(
            F.count("*").alias("projects"),
            round_half_away(avg_decimal(confidence, 3), 3).alias("avg_confidence"),
        )
        .orderBy(F.desc("projects"), "readiness_status")
    )


def _long(section: str, wide: DataFrame) -> DataFrame:
    entries = [
        F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("value"))
        for name in wide.columns
    ]
    return wide.select(F.explode(F.array(*entries)).alias("entry")).select(
        F.lit(section).alias("section"), "entry.metric", "entry.value"
    )


def _rows(section: str, frame: DataFrame, metric: str, value: str) -> DataFrame:
    return frame.select(
        F.lit(section).alias("section"),
        F.col(metric).cast("string").alias("metric"),
        F.col(value).cast("double").alias("value"),
    )


def summary(
    projects: DataFrame,
    pages: DataFrame,
    takeoffs: DataFrame,
    estimate_totals: ValueHistogram,
    reviews: DataFrame,
    dashboard: DataFrame,
    checks: DataFrame,
) -> DataFrame:
    """The whole report as (section, metric, value).

    The quality line comes from the checks: 1 if all of them passed.
    """
    verdict = checks.where(F.col("check") == "all").select(
        F.lit("quality").alias("section"),
        F.lit("all_checks_passed").alias("metric"),
        F.col("passed").cast("double").alias("value"),
    )
    disciplines = pages_by_discipline(pages).withColumn(
        "sheet_group", F.concat_ws(" ", "discipline", "discipline_name")
    )
    return reduce(
        DataFrame.unionByName,
        [
            _long("summary", counts(projects, pages)),
            _long("takeoffs", takeoff_stats(takeoffs)),
            _long("estimates", estimate_stats(estimate_totals)),
            _rows("pages", disciplines, "sheet_group", "page_count"),
            _rows("top_cost_codes", top_cost_codes(takeoffs), "cost_code", "total_extended_cost"),
            _long("qa", qa_stats(reviews, projects)),
            _rows("readiness", readiness(dashboard), "readiness_status", "project_count"),
            verdict,
        ],
    )
