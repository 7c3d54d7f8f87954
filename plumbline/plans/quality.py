"""Declared data tests, warehouse checks and the two fact checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from plumbline import fixed_values as fixed
from plumbline.functions import avg_decimal, conditional_count, percent, round_half_away
from plumbline.operators import data_tests
from plumbline.plans import staging
from plumbline.schemas import RAW_TABLES

# Gives the frame of a table named as in ``fixed_values``.
Tables = data_tests.Tables


# --- offending rows -----------------------------------------------------------


def _not_positive() -> Column:
    return F.col("quantity") <= 0


def _outside_range() -> Column:
    return (F.col("confidence") < 0) | (F.col("confidence") > 1)


def positive_quantities(takeoffs: DataFrame) -> DataFrame:
    return takeoffs.where(_not_positive()).select("takeoff_id", "quantity")


def valid_confidence(takeoffs: DataFrame) -> DataFrame:
    return takeoffs.where(_outside_range()).select("takeoff_id", "confidence")


# --- declared tests -------------------------------------------------------------

# A staged table is tested in the pass over its raw one.
STAGED = {
    f"stg_{name}": (f"raw.{name}", getattr(staging, f"stg_{name}")) for name in RAW_TABLES
}


def _results(tables: Tables, declared: data_tests.Declared) -> DataFrame:
    return data_tests.results(tables, declared, STAGED)


def _row_tests(table: str) -> list[data_tests.RowTest]:
    return [
        data_tests.RowTest("positive_quantities", table, "quantity", _not_positive()),
        data_tests.RowTest("valid_confidence", table, "confidence", _outside_range()),
    ]


def unique_results(tables: Tables) -> DataFrame:
    return _results(tables, data_tests.Declared(unique=fixed.UNIQUE))


def not_null_results(tables: Tables) -> DataFrame:
    return _results(tables, data_tests.Declared(not_null=fixed.NOT_NULL))


def accepted_values_results(tables: Tables) -> DataFrame:
    return _results(tables, data_tests.Declared(accepted_values=fixed.ACCEPTED_VALUES))


def relationships_results(tables: Tables) -> DataFrame:
    return _results(tables, data_tests.Declared(relationships=fixed.RELATIONSHIPS))


def test_results(tables: Tables) -> DataFrame:
    """All declared tests and the two row tests, from one pass over every table."""
    every = data_tests.Declared(
        unique=fixed.UNIQUE,
        not_null=fixed.NOT_NULL,
        accepted_values=fixed.ACCEPTED_VALUES,
        relationships=fixed.RELATIONSHIPS,
        row_tests=_row_tests("stg_takeoff_items"),
    )
    return _results(tables, every)


def orphans(tables: Tables) -> DataFrame:
    """Staged rows whose parent is missing, per missing key."""
    staged = [
        (child.replace("raw.", "stg_"), column, parent.replace("raw.", "stg_"), parent_column)
        for child, column, parent, parent_column in fixed.RELATIONSHIPS
    ]
    return data_tests.orphan_keys(tables, staged)


# --- warehouse checks -------------------------------------------------------------


def _high_low_confidence() -> Column:
    return F.col("pct_low_confidence") > fixed.MAX_LOW_CONFIDENCE_PCT


def high_low_confidence_projects(dashboard: DataFrame) -> DataFrame:
    """Projects with too many low-confidence takeoffs; those without takeoffs have no share."""
    return dashboard.where(_high_low_confidence()).select("project_id", "project_name", "pct_low_confidence")


def first_high_low_confidence_projects(dashboard: DataFrame) -> DataFrame:
    return high_low_confidence_projects(dashboard).orderBy("project_id").limit(3)


def _low_confidence() -> Column:
    # From the rounded confidence of the fact, unlike the staged flag.
    return F.col("confidence") < F.lit(str(fixed.LOW_CONFIDENCE)).cast("decimal(5,3)")


def takeoff_measures() -> dict[str, Column]:
    """What the checks need of the takeoff fact, as aggregates."""
    confidence = F.col("confidence")
    return {
        "invalid_quantities": F.count_if(_not_positive()),
        "invalid_confidence": F.count_if(_outside_range()),
        "total_takeoffs": F.count("*"),
        "avg_confidence": round_half_away(avg_decimal(confidence, 3), 3),
        "low_confidence_count": conditional_count(_low_confidence()),
        "total_extended_cost": F.sum("extended_cost_mid").cast("double"),
    }


def estimate_measures() -> dict[str, Column]:
    total_mid = F.col("estimate_total_mid")
    return {
        "zero_estimates": F.count_if(total_mid.isNull() | (total_mid == 0)),
        "total_estimates": F.count("*"),
        "total_estimate_value": F.sum(total_mid).cast("double"),
        "avg_estimate": round_half_away(avg_decimal(total_mid, 2), 2),
    }


def dashboard_measures() -> dict[str, Column]:
    return {"projects_with_high_low_confidence": F.count_if(_high_low_confidence())}


def _measured(rows: DataFrame, measures: dict[str, Column]) -> DataFrame:
    return rows.agg(*[measure.alias(name) for name, measure in measures.items()])


def checks_summary(takeoffs: DataFrame, estimates: DataFrame, dashboard: DataFrame) -> DataFrame:
    """``checks_of`` over tables that were not measured when they were written; each is aggregated once."""
    return checks_of(
        _measured(takeoffs, takeoff_measures()),
        _measured(estimates, estimate_measures()),
        _measured(dashboard, dashboard_measures()),
        dashboard,
    )


def checks_of(
    takeoffs: DataFrame, estimates: DataFrame, dashboard: DataFrame, projects: DataFrame
) -> DataFrame:
    """Warehouse checks as (check, value, passed, issue).

    Four rows are checks, the others metrics without a verdict, and ``all``
    counts the failed checks. The first three frames are the measures of the
    facts and the dashboard, one row each; ``projects`` is the dashboard, of
    which the first offenders are named. The one-row frames are put side by
    side and unfolded.
    """
    names = first_high_low_confidence_projects(projects).agg(
        F.concat_ws(
            ", ",
            F.transform(
                F.sort_array(F.collect_list(F.struct("project_id", "project_name"))),
                lambda project: project["project_name"],
            ),
        ).alias("names")
    )
    parts = [
        takeoffs.select(*takeoff_measures()),
        estimates.select(*estimate_measures()),
        dashboard.select(*dashboard_measures()),
        names,
    ]
    wide = reduce(lambda one, two: one.unionByName(two, allowMissingColumns=True), parts)
    wide = wide.agg(*[F.max(name).alias(name) for name in wide.columns])

    issues = {
        "invalid_quantities": F.lit(" takeoffs with a non-positive quantity"),
        "invalid_confidence": F.lit(" takeoffs with a confidence outside 0 to 1"),
        "projects_with_high_low_confidence": F.concat(
            F.lit(" projects with too many low-confidence takeoffs, first: "), F.col("names")
        ),
        "zero_estimates": F.lit(" estimates with a zero or missing total"),
    }
    metrics = [
        "total_takeoffs", "avg_confidence", "low_confidence_count", "total_extended_cost",
        "total_estimates", "total_estimate_value", "avg_estimate",
    ]
    failed = sum((F.col(name) > 0).cast("int") for name in issues)

    def entry(check: str, value: Column, passed: Column, issue: Column) -> Column:
        return F.struct(
            F.lit(check).alias("check"),
            F.coalesce(value.cast("double"), F.lit(0.0)).alias("value"),
            passed.cast("boolean").alias("passed"),
            issue.cast("string").alias("issue"),
        )

    entries = [
        entry(
            name,
            F.col(name),
            F.col(name) == 0,
            F.when(F.col(name) > 0, F.concat(F.col(name).cast("string"), text)),
        )
        for name, text in issues.items()
    ]
    entries += [entry(name, F.col(name), F.lit(None), F.lit(None)) for name in metrics]
    entries.append(entry("all", failed, failed == 0, F.lit(None)))
    return wide.select(F.explode(F.array(*entries)).alias("entry")).select("entry.*")


# --- fact checks ------------------------------------------------------------------


def check_valid_quantities(takeoffs: DataFrame) -> DataFrame:
    """All quantities positive. Over no rows the count is NULL and the check fails."""
    counts = takeoffs.agg(
        F.count("*").alias("total_takeoffs"),
        conditional_count(F.col("quantity") <= 0).alias("invalid_quantities"),
    )
    total, invalid = F.col("total_takeoffs"), F.col("invalid_quantities")
    passed = F.coalesce(invalid == 0, F.lit(False))
    return counts.select(
        total,
        invalid,
        F.coalesce(percent(total - invalid, total, 2), F.lit(0.0)).alias("pct_valid"),
        passed.alias("passed"),
        F.when(passed, "WARN").otherwise("ERROR").alias("severity"),
    )


def check_confidence_distribution(takeoffs: DataFrame) -> DataFrame:
    """Share of low-confidence takeoffs within its limit. Over no rows the check passes."""
    counts = takeoffs.agg(
        F.count("*").alias("total_takeoffs"),
        avg_decimal(F.col("confidence"), 3).alias("mean"),
        conditional_count(_low_confidence()).alias("low_confidence_count"),
    )
    total = F.col("total_takeoffs")
    low = F.col("low_confidence_count").cast("double")
    pct_low = F.when(total > 0, low / total.cast("double") * F.lit(100.0)).otherwise(F.lit(0.0))
    return counts.select(
        total,
        F.coalesce(round_half_away(F.col("mean"), 3), F.lit(0.0)).alias("avg_confidence"),
        "low_confidence_count",
        round_half_away(pct_low, 2).alias("pct_low_confidence"),
        F.lit(fixed.LOW_CONFIDENCE).alias("threshold"),
        (pct_low <= fixed.MAX_LOW_CONFIDENCE_PCT).alias("passed"),
        F.lit("WARN").alias("severity"),
    )
