"""Declared data tests: their number, and planted violations."""

from pyspark.sql import functions as F
from rows import DEFAULTS, table

from plumbline import fixed_values as fixed
from plumbline.operators import data_tests
from plumbline.plans import quality, stages
from plumbline.sources.tables import TableStore


def test_declared_tests():
    assert sum(len(columns) for columns in fixed.UNIQUE.values()) == 17
    assert sum(len(columns) for columns in fixed.NOT_NULL.values()) == 47
    assert sum(len(columns) for columns in fixed.ACCEPTED_VALUES.values()) == 16
    assert len(fixed.RELATIONSHIPS) == 8


def failures(tables, **declared):
    found = data_tests.results(tables.__getitem__, data_tests.Declared(**declared)).collect()
    assert all(r["passed"] == (r["failures"] == 0) and r["severity"] == "warn" for r in found)
    return {(r["test"], r["table_name"], r["column_name"]): r["failures"] for r in found}


def test_unique_ignores_nulls(spark):
    rows = spark.createDataFrame([(1,), (1,), (1,), (2,), (3,), (3,), (None,), (None,)], "k int")
    assert failures({"t": rows}, unique={"t": ["k"]}) == {("unique", "t", "k"): 2}
    keys = data_tests.unusable_keys(rows, "k").first()
    assert (keys["repeated"], keys["missing"]) == (2, 1)


def test_not_null_per_column(spark):
    rows = spark.createDataFrame([(1, None), (None, None), (3, 4)], "a int, b int")
    declared = {"t": ["a", "b"]}
    assert list(failures({"t": rows}, not_null=declared).values()) == [1, 2]
    assert list(failures({"t": rows.where("false")}, not_null=declared).values()) == [0, 0]


def test_accepted_values_counts_distinct_offenders(spark):
    rows = spark.createDataFrame(
        [("x", "p"), ("y", "q"), ("z", "q"), ("z", None), (None, "r")], "a string, b string"
    )
    found = failures({"t": rows}, accepted_values={"t": {"a": ["x"], "b": ["p", "q", "r"]}})
    assert found == {("accepted_values", "t", "a"): 2, ("accepted_values", "t", "b"): 0}


def test_relationships_count_rows_and_ignore_nulls(spark):
    child = spark.createDataFrame([(1,), (7,), (7,), (8,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "p int")
    tables = {"c": child, "p": parent}
    declared = [("c", "k", "p", "p")]
    assert failures(tables, relationships=declared) == {("relationships", "c", "k"): 3}
    orphans = data_tests.orphan_keys(tables.__getitem__, declared).collect()
    assert {(row["missing_key"], row["rows"]) for row in orphans} == {("7", 2), ("8", 1)}


def test_one_table_may_be_parent_child_and_unique(spark):
    """Keys with several roles, and two children of one parent."""
    a = spark.createDataFrame([(1, 2), (2, 2), (2, 9)], "id int, up int")
    b = spark.createDataFrame([(9,), (1,), (4,)], "up int")
    found = failures(
        {"a": a, "b": b},
        unique={"a": ["id", "up"], "b": ["up"]},
        relationships=[("a", "up", "a", "id"), ("b", "up", "a", "id"), ("a", "id", "b", "up")],
        row_tests=[data_tests.RowTest("odd", "b", "up", F.col("up") % 2 == 1)],
    )
    assert found == {
        ("unique", "a", "id"): 1, ("unique", "a", "up"): 1, ("unique", "b", "up"): 0,
        ("relationships", "a", "up"): 1, ("relationships", "b", "up"): 2, ("relationships", "a", "id"): 2,
        ("odd", "b", "up"): 2,
    }


def test_all_tests_share_one_shuffle(spark, tmp_path):
    """Every stored table is read at most twice, as raw and as staged, whatever is declared."""
    raw = {name: table(spark, name, {}) for name in DEFAULTS}
    store = TableStore(spark, str(tmp_path / "tables"))
    stages.run_all(spark, raw, str(tmp_path / "csv"), store, "2024-06-01 00:00:00")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    tests = quality.test_results(lambda name: stages.table(store, name))
    plan = tests._jdf.queryExecution().sparkPlan().toString()
    for name in [*DEFAULTS, "fct_takeoffs", "fct_estimates", "mart_estimation_dashboard"]:
        path = f"{tmp_path}/tables/{'raw/' if name in DEFAULTS else ''}{name}/"
        assert 1 <= plan.count(path) <= 2, name
    executed = tests._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange") <= 4
    # and the checks read no fact at all
    checks = quality.checks_of(
        *[store.measures(name) for name in ("fct_takeoffs", "fct_estimates", "mart_estimation_dashboard")],
        store.read("mart_estimation_dashboard"),
    )
    plan = checks._jdf.queryExecution().sparkPlan().toString()
    assert not any(f"{tmp_path}/tables/{name}/{side}]" in plan for name in ("fct_takeoffs", "fct_estimates") for side in (0, 1))
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_planted_violations_are_found(spark):
    raw = {name: table(spark, name, {}) for name in DEFAULTS}
    raw["takeoff_items"] = table(
        spark, "takeoff_items", dict(takeoff_id=1), dict(takeoff_id=1, page_id=9, cost_code="none"),
        dict(project_id=None, extraction_method="guess", quantity=-1.0, confidence=2.0),
    )

    def tables(name):
        if name.startswith("raw."):
            return raw[name.removeprefix("raw.")]
        if name.startswith("stg_"):
            return stages.STAGING[name.removeprefix("stg_")](raw[name.removeprefix("stg_")])
        return tables("stg_takeoff_items")

    failed = {
        (row["test"], row["column_name"])
        for row in quality.relationships_results(tables)
        .unionByName(data_tests.results(tables, data_tests.Declared(unique={"raw.takeoff_items": ["takeoff_id"]})))
        .where("NOT passed")
        .collect()
    }
    assert failed == {
        ("relationships", "page_id"), ("relationships", "cost_code"), ("unique", "takeoff_id"),
    }
    orphans = quality.orphans(tables).collect()
    assert {(row["child_table"], row["missing_key"]) for row in orphans} == {
        ("stg_takeoff_items", "9"), ("stg_takeoff_items", "none"),
    }


def test_a_staged_table_is_tested_in_the_pass_over_its_raw_one(spark):
    raw = spark.createDataFrame([(1, None), (1, "x"), (2, "y")], "id int, name string")

    def staged(rows):
        return rows.withColumn("name", F.lower("name")).withColumn("id", F.col("id") % 2)

    read = []

    def tables(name):
        read.append(name)
        return {"raw.t": raw, "stg_t": staged(raw)}[name]

    declared = data_tests.Declared(
        unique={"raw.t": ["id"], "stg_t": ["id", "name"]}, not_null={"raw.t": ["name"], "stg_t": ["name", "id"]},
        accepted_values={"stg_t": {"name": ["x"]}},
    )
    alone = data_tests.results(tables, declared).collect()
    assert sorted(set(read)) == ["raw.t", "stg_t"]
    read.clear()
    together = data_tests.results(tables, declared, {"stg_t": ("raw.t", staged)}).collect()
    assert read == ["raw.t"] and sorted(map(str, together)) == sorted(map(str, alone))
