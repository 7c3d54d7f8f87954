"""Whole results and split tasks when one key holds a third of the rows.

Thresholds are scaled down so that adaptive execution sees the small data as
it would see large data.
"""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F
from rows import table

from plumbline.operators.salting import HotKeys, grid_join
from plumbline.plans import marts, rollups, staging
from plumbline.sources.tables import scratch_keep

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}
ROWS = 60_000


@contextmanager
def scaled_down(spark):
    before = {name: spark.conf.get(name) for name in SMALL}
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def repeated(spark, name, key, rows):
    """Rows of a raw table with the numbers 0 to ``rows`` as their key."""
    columns = table(spark, name, {}).drop(key)
    literals = [F.lit(value).cast(field.dataType).alias(field.name) for field, value in zip(columns.schema, columns.first())]
    return spark.range(0, rows, 1, 8).select(F.col("id").alias(key), *literals)


@pytest.fixture(scope="module")
def frames(spark):
    key = F.col("takeoff_id")

    def mostly_zero(others):
        return F.when(key % 3 == 0, 0).otherwise(F.pmod(F.hash(key), others)).cast("bigint")

    takeoffs = repeated(spark, "takeoff_items", "takeoff_id", ROWS).withColumns(
        {
            "page_id": mostly_zero(500),
            "project_id": mostly_zero(100),
            "cost_code": F.concat(F.lit("C"), mostly_zero(50).cast("string")),
        }
    )
    costs = repeated(spark, "cost_library", "n", 50).withColumn(
        "cost_code", F.concat(F.lit("C"), F.col("n").cast("string"))
    )
    return {
        "takeoffs": staging.stg_takeoff_items(takeoffs),
        "pages": staging.stg_blueprint_pages(repeated(spark, "blueprint_pages", "page_id", 500)),
        "projects": staging.stg_projects(repeated(spark, "projects", "project_id", 100)),
        "costs": staging.stg_cost_library(costs.drop("n")),
        "estimates": staging.stg_estimates(
            repeated(spark, "estimates", "estimate_id", ROWS).withColumn(
                "project_id",
                F.when(F.col("estimate_id") % 3 == 0, 0).otherwise(F.col("estimate_id") % 100),
            )
        ),
        "lines": staging.stg_estimate_line_items(
            repeated(spark, "estimate_line_items", "line_item_id", 100).withColumn(
                "estimate_id", F.col("line_item_id")
            )
        ),
    }




def final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_takeoff_fact_splits_hot_keys(spark, frames):
    with scaled_down(spark):
        fact = marts.fct_takeoffs(
            frames["takeoffs"], frames["pages"], frames["projects"], frames["costs"]
        ).select("takeoff_id", "page_title", "client_name", "division", "line_total")
        plan = final_plan(fact)
        assert fact.count() == ROWS
        assert fact.select(F.count_distinct("takeoff_id")).first()[0] == ROWS
    # Page, project and cost code are hot; each join splits its own hot key.
    assert plan.split("Initial Plan")[0].count("skew=true") == 3


def test_estimate_fact_keeps_all_rows_of_a_hot_project(spark, frames):
    with scaled_down(spark):
        fact = marts.fct_estimates(
            frames["estimates"],
            frames["projects"],
            frames["lines"],
            marts.takeoffs_by_project(frames["takeoffs"]),
            hot_rows=1000,
        )
        counts = {
            row["project_id"]: row["count"] for row in fact.groupBy("project_id").count().collect()
        }
        hot = fact.where("project_id = 0").select("total_takeoff_items").distinct().collect()
    assert sum(counts.values()) == ROWS and counts[0] > ROWS // 3
    expected = frames["takeoffs"].where("project_id = 0").count()
    assert [row["total_takeoff_items"] for row in hot] == [expected]


@pytest.mark.parametrize("a, b", [(3000, 40), (40, 3000), (700, 700), (5, 2)])
def test_a_grid_cuts_a_key_that_is_hot_on_both_sides(spark, a, b):
    cell = 2000
    left = spark.range(a).selectExpr("id AS x", "if(id < 9, id + 1, 0) AS k")
    right = spark.range(b).selectExpr("id AS y", "if(id < 5, id + 1, 0) AS k")
    with scaled_down(spark):
        spark.conf.set("spark.sql.shuffle.partitions", "97")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        joined = grid_join(left, right, "k", F.col("x"), F.col("y"), scratch_keep(spark), "crowded", cell)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    plain = left.join(right, "k")
    assert joined.columns == ["k", "x", "y"] and joined.count() == plain.count()
    assert joined.exceptAll(plain.select("k", "x", "y")).count() == 0
    # A cell is a group of its own; some share a task.
    assert max(sizes) <= 5 * max(cell, sum(sizes) / 97) and len(sizes) >= min(30, a * b // cell // 3)


def test_line_items_of_a_project_with_many_estimates_and_codes(spark, frames):
    """10,000 estimates times 100 codes of one project: whole results, in many tasks."""
    estimates = spark.range(10_000).selectExpr("id AS estimate_id", "0L AS project_id")
    takeoffs = frames["takeoffs"].limit(0).unionByName(
        staging.stg_takeoff_items(
            repeated(spark, "takeoff_items", "takeoff_id", 100).withColumns(
                {"project_id": F.lit(0).cast("bigint"), "cost_code": F.concat(F.lit("C"), F.col("takeoff_id").cast("string"))}
            )
        )
    )
    costs = staging.stg_cost_library(
        repeated(spark, "cost_library", "n", 100)
        .withColumn("cost_code", F.concat(F.lit("C"), F.col("n").cast("string")))
        .drop("n")
    )
    with scaled_down(spark):
        spark.conf.set("spark.sql.shuffle.partitions", "97")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        items = rollups.estimate_line_item_rollup(estimates, takeoffs, costs, scratch_keep(spark), cell_rows=10_000)
        sizes = [r["count"] for r in items.groupBy(F.spark_partition_id()).count().collect()]
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        assert sum(sizes) == 1_000_000 and max(sizes) <= 60_000
        assert items.select("estimate_id", "cost_code").distinct().count() == 1_000_000


def test_estimate_fact_counts_no_key_where_none_is_hot(spark, frames):
    hot = HotKeys.find(frames["estimates"], "project_id", scratch_keep(spark), "projects")
    assert hot.number == 0
    fact = marts.fct_estimates(
        frames["estimates"], frames["projects"], frames["lines"], marts.takeoffs_by_project(frames["takeoffs"]), hot
    )
    assert "_salt" not in fact._jdf.queryExecution().optimizedPlan().toString()
    few = HotKeys.find(frames["estimates"], "project_id", scratch_keep(spark), "projects", 1000)
    fact = marts.fct_estimates(
        frames["estimates"], frames["projects"], frames["lines"], marts.takeoffs_by_project(frames["takeoffs"]), few, 1000
    )
    assert few.number == 1 and fact.count() == ROWS
