"""Tables in buckets of a key: stored sides, joins without a shuffle, hot keys in pieces."""

import pytest
from pyspark.sql import functions as F
from test_skew import ROWS, frames, scaled_down  # noqa: F401

from plumbline.operators.colocated import PIECE, colocate, common_key
from plumbline.plans import marts
from plumbline.sources.tables import TableStore

TAKEOFFS, PAGES = "colocated.takeoff_items", "colocated.blueprint_pages"


def exchanges(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan


def without_times(fact):
    return fact.drop(marts.UPDATED_AT)


def store_frames(stored):
    store, _, _ = stored
    return store, store.read(TAKEOFFS), store.read(PAGES)


@pytest.fixture(scope="module")
def stored(spark, frames, tmp_path_factory):  # noqa: F811
    store = TableStore(spark, str(tmp_path_factory.mktemp("colocated")))
    takeoffs, pages = colocate(
        store, (TAKEOFFS, frames["takeoffs"]), (PAGES, frames["pages"]), "page_id", F.col("takeoff_id"), 16, 1000
    )
    return store, takeoffs, pages


def test_a_table_in_buckets_has_two_sides(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    rows = spark.range(100).selectExpr("id", "id % 7 AS `odd name`", "timestamp_ntz'2024-01-02 03:04:05' AS at")
    for most in (100, 40, 0, 9):
        before = store.replace("t", rows.where(F.col("id") < most), buckets=4, bucket_by=["odd name"])
        assert store.row_count("t") == before.count() == most and before.schema == store.read("t").schema
    assert store.replace("t", store.read("t").where("id > 4"), buckets=3, bucket_by=["id"]).count() == 4
    assert store.replace("t", rows).count() == 100  # no buckets any more
    broken = rows.selectExpr("if(id = 50, raise_error('broken'), id) AS id")
    with pytest.raises(Exception, match="broken"):
        store.replace("t", broken, buckets=4, bucket_by=["id"])
    assert store.read("t").count() == 100
    with pytest.raises(ValueError, match="apart"):
        store.replace("t", rows, apart=F.col("id") > 1, buckets=4, bucket_by=["id"])


def test_another_session_finds_the_buckets(spark, stored):
    store = stored[0]
    for found in spark.catalog.listTables():
        if found.name.startswith("plumbline_"):
            spark.sql(f"DROP TABLE {found.name}")
    again = TableStore(spark.newSession(), store.root)
    left, right = again.read(TAKEOFFS), again.read(PAGES)
    again.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    joined = left.join(right.select("page_id", PIECE, "page_title"), common_key(left, right, "page_id"))
    assert exchanges(joined)[0] == 0 and joined.count() == ROWS


def test_the_fact_shuffles_twice(spark, frames, stored):  # noqa: F811
    _, takeoffs, pages = store_frames(stored)
    with scaled_down(spark):
        plain = marts.fct_takeoffs(frames["takeoffs"], frames["pages"], frames["projects"], frames["costs"])
        fact = marts.fct_takeoffs(takeoffs, pages, frames["projects"], frames["costs"])
        number, plan = exchanges(fact)
        # By cost code and by project, and the other side of each; none by page.
        assert number == 4 and exchanges(plain)[0] == 6
        assert plan.count("hashpartitioning(cost_code") == 2 and plan.count("hashpartitioning(project_id") == 2
        assert fact.columns == plain.columns and fact.count() == ROWS
        assert without_times(fact).exceptAll(without_times(plain)).count() == 0


def test_the_quality_mart_is_the_same(spark, frames, stored):  # noqa: F811
    _, takeoffs, pages = store_frames(stored)
    rest = frames["projects"], spark.createDataFrame([], "project_id bigint, resolved boolean, is_critical boolean, severity_score int")
    with scaled_down(spark):
        plain = marts.mart_takeoff_quality_monitoring(frames["takeoffs"], frames["pages"], *rest)
        mart = marts.mart_takeoff_quality_monitoring(takeoffs, pages, *rest)
        assert exchanges(mart)[0] == exchanges(plain)[0] - 2
        assert mart.count() == plain.count() == 100
        assert without_times(mart).exceptAll(without_times(plain)).count() == 0


def test_a_hot_page_is_in_many_buckets(spark, stored):
    _, takeoffs, pages = store_frames(stored)
    sizes = [r["count"] for r in takeoffs.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == ROWS and len(sizes) == 16
    # A third of the rows is of one page, a piece for each 1000 of them; no bucket has much more than its share.
    assert max(sizes) <= 3 * ROWS // 16
    hot = takeoffs.where("page_id = 0").count()
    pieces = -(-hot // 1000)
    assert hot >= ROWS // 3 and takeoffs.where("page_id = 0").select(PIECE).distinct().count() == pieces
    assert pages.where("page_id = 0").count() == pieces and pages.where("page_id <> 0").count() == 499


def test_odd_keys(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    rows = spark.createDataFrame([(1, None), (2, 5), (3, 5), (4, 5), (5, 9)], "n int, k int")
    lookup = spark.createDataFrame([(5, "five"), (None, "none"), (7, "seven")], "k int, v string")
    for hot_rows in (1, 100):
        left, right = colocate(store, ("l", rows), ("r", lookup), "k", F.col("n"), 4, hot_rows)
        assert left.count() == 5
        found = left.join(right, common_key(left, right, "k"))
        assert sorted((r["n"], r["v"]) for r in found.collect()) == [(2, "five"), (3, "five"), (4, "five")]
    left, right = colocate(store, ("l", rows.limit(0)), ("r", lookup.limit(0)), "k", F.col("n"), 4)
    assert left.join(right, common_key(left, right, "k")).count() == 0
