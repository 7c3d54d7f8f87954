"""Operators against brute force, with one key holding a third of all rows or more."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.operators.latest import latest_per_key
from plumbline.operators.numbering import number_within
from plumbline.operators.value_histogram import ValueHistogram
from plumbline.sources.tables import TableStore, scratch_keep
from plumbline.operators.salting import salted_join


def executed_plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows; key 0 holds a third of them, the others 20 each."""
    return spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 100 + 1).alias("key"),
        F.pmod(F.hash("id"), 50).alias("day"),
        F.pmod(F.hash("id", F.lit(1)), 7).alias("version"),
    )


def test_number_within_equals_row_number(skewed):
    numbered = number_within(
        skewed, "key", {"_day": F.col("day"), "_block": F.expr("id div 1000")},
        [F.col("day"), F.col("id")], "n",
    ).toPandas()
    ordered = numbered.sort_values(["key", "day", "id"])
    assert (ordered.groupby("key").cumcount() + 1 == ordered["n"]).all()
    assert len(numbered) == 3000


def test_number_within_keeps_null_keys_and_buckets(spark):
    rows = spark.createDataFrame(
        pd.DataFrame({"id": [1, 2, 3, 4, 5, 6], "key": [None, None, None, "a", "a", "a"],
                      "day": [2.0, None, 1.0, None, 3.0, None]})
    ).withColumn("day", F.when(~F.isnan("day"), F.col("day")))
    numbered = number_within(
        rows, "key", {"_day": F.col("day")}, [F.asc_nulls_last("day"), F.asc("id")], "n"
    )
    assert {row["id"]: row["n"] for row in numbered.collect()} == {1: 2, 2: 3, 3: 1, 4: 2, 5: 1, 6: 3}


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [10, 300, 10_000])
def test_salted_join_equals_plain_join(spark, skewed, how, hot_rows):
    lookup = spark.range(0, 60).select(
        F.col("id").alias("key"), (F.col("id") * 2).alias("looked_up")
    )
    salted = salted_join(skewed, lookup, "key", F.col("id"), how=how, hot_rows=hot_rows)
    plain = skewed.join(lookup, "key", how)
    assert sorted(salted.columns) == sorted(plain.columns)
    columns = sorted(plain.columns)
    assert salted.select(columns).exceptAll(plain.select(columns)).count() == 0
    assert salted.count() == plain.count()


def test_salted_join_spreads_the_hot_key(spark, skewed):
    lookup = spark.range(0, 200).withColumnRenamed("id", "key")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = salted_join(skewed, lookup, "key", F.col("id"), hot_rows=50)
        sizes = (
            joined.where("key = 0").groupBy(F.spark_partition_id()).count().toPandas()["count"]
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sizes.sum() == 1000 and len(sizes) > 4 and sizes.max() < 500


@pytest.mark.parametrize("partitions", [1, 7])
@pytest.mark.parametrize("rows", [1, 2, 11, 1000])
def test_percentiles_equal_numpy(spark, rows, partitions):
    random = np.random.default_rng(rows)
    cents = random.integers(-5_000, 90_000, rows)
    cents[: rows // 3] = 777
    frame = spark.createDataFrame(pd.DataFrame({"cents": cents})).select(
        (F.col("cents").cast("decimal(12,0)") / 100).cast("decimal(14,2)").alias("amount")
    )
    frame = frame.unionByName(spark.sql("SELECT CAST(NULL AS DECIMAL(14, 2)) AS amount"))
    points = {"least": 0.0, "low": 0.1, "mid": 0.5, "high": 0.9, "top": 1.0}
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    histogram = ValueHistogram.build(frame, "amount", scratch_keep(spark), "amounts")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    row = histogram.percentiles(points).first()
    for name, point in points.items():
        assert row[name] == pytest.approx(np.quantile(cents / 100, point), abs=1e-9)
    assert (histogram.rows, histogram.valued, histogram.unit_sum) == (rows + 1, rows, cents.sum())
    assert histogram.mean() == pytest.approx(cents.mean() / 100)
    values = histogram.values.orderBy("units").collect()
    assert values[0]["rows_before"] == 0 and values[-1]["rows_through"] == rows
    assert all(a["rows_through"] == b["rows_before"] for a, b in zip(values, values[1:]))


def test_percentiles_of_nothing(spark):
    for rows in ("SELECT CAST(NULL AS DECIMAL(14, 2)) AS amount", "SELECT CAST(1 AS DECIMAL(14, 2)) AS amount WHERE rand() > 2"):
        histogram = ValueHistogram.build(spark.sql(rows), "amount", scratch_keep(spark), "amounts")
        assert histogram.percentiles({"mid": 0.5}).first()["mid"] is None and histogram.mean() is None


def test_percentiles_are_lookups(spark, tmp_path):
    """The rows are read by the one job that counts them; ranks reach the stored values as filters."""
    amounts = spark.range(5000).selectExpr("cast(id % 900 as decimal(14, 2)) AS amount")
    store = TableStore(spark, str(tmp_path))
    ValueHistogram.build(amounts, "amount", store.keep, "amounts")
    again = ValueHistogram.of(store.read("amounts"), store.measures("amounts_counts").first())
    found = again.percentiles({"mid": 0.5, "high": 0.9})
    plan = executed_plan(found)
    assert plan.count("FileScan") <= 2 and "LessThanOrEqual(rows_before" in plan and "Range (" not in plan
    assert found.first()["mid"] == 416 and found.first()["high"] == pytest.approx(799.1)


def test_latest_per_key(skewed):
    latest = latest_per_key(skewed, "key", [F.desc("version"), F.desc("id")])
    found = latest.toPandas().set_index("key")["id"]
    everything = skewed.toPandas().sort_values(["version", "id"])
    expected = everything.groupby("key")["id"].last()
    assert found.sort_index().equals(expected.sort_index())


def test_latest_per_key_limits_before_the_shuffle(skewed):
    plan = executed_plan(latest_per_key(skewed, "key", [F.desc("version"), F.desc("id")]))
    assert "WindowGroupLimit" in plan and "Partial" in plan
