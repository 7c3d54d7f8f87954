"""Price history: every kind of change, invariants and lookups."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from rows import table

from plumbline.operators import history as scd
from plumbline.operators.salting import HotKeys
from plumbline.plans import snapshots, stages
from plumbline.sources.tables import TableStore, scratch_keep

RUNS = ["2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00", "2024-04-01 00:00:00"]


def costs(spark, **prices):
    return table(
        spark, "cost_library",
        *[
            dict(cost_code=code, unit_cost_mid=price, **more)
            for code, (price, more) in prices.items()
        ],
    )


@pytest.fixture(scope="module")
def deliveries(spark):
    kept, none = (1.0, {}), (None, {})
    return [
        costs(spark, same=kept, priced=(2.0, {}), gone=kept, null=none, unit=kept),
        costs(
            spark, same=kept, priced=(3.0, {}), null=none, unit=(1.0, dict(uom="LS")), new=kept
        ),
        costs(spark, same=kept, priced=(3.0, {}), gone=kept, null=(4.0, {}), unit=kept, new=kept),
    ]


@pytest.fixture(scope="module")
def history(spark, deliveries):
    state = snapshots.initial(deliveries[0], RUNS[0])
    for run, rows in zip(RUNS[1:], [*deliveries[1:], deliveries[2]]):
        state = snapshots.merged(state, rows, run)
    return state.cache()


def versions(history, code):
    rows = history.where(F.col("cost_code") == code).orderBy("valid_from").collect()
    return [
        (
            row["unit_cost_mid"],
            RUNS.index(str(row["valid_from"])),
            None if row["valid_to"] is None else RUNS.index(str(row["valid_to"])),
        )
        for row in rows
    ]


def test_versions(history):
    assert versions(history, "same") == [(1.0, 0, None)]
    assert versions(history, "priced") == [(2.0, 0, 1), (3.0, 1, None)]
    assert versions(history, "gone") == [(1.0, 0, 1), (1.0, 2, None)]
    assert versions(history, "null") == [(None, 0, 2), (4.0, 2, None)]
    assert versions(history, "new") == [(1.0, 1, None)]
    # A new unit alone opens no version and leaves the stored unit as it was.
    assert versions(history, "unit") == [(1.0, 0, None)]
    assert history.where("cost_code = 'unit'").first()["uom"] == "CY"


def test_invariants(history):
    open_rows = history.where("valid_to IS NULL").groupBy("cost_code").count()
    assert open_rows.where("count > 1").count() == 0
    pairs = history.alias("a").join(
        history.alias("b"),
        F.expr("a.cost_code = b.cost_code AND a.valid_from < b.valid_from"),
    )
    assert pairs.where("a.valid_to IS NULL OR a.valid_to > b.valid_from").count() == 0
    assert history.select("scd_id").distinct().count() == history.count()


def test_no_change_is_a_no_op(history, deliveries):
    again = snapshots.merged(history, deliveries[2], "2024-05-01 00:00:00")
    assert again.exceptAll(history).count() == 0 and again.count() == history.count()


def test_withdrawn_codes_may_stay_open(spark, deliveries):
    from plumbline.operators.history import merge_history

    state = snapshots.initial(deliveries[0], RUNS[0])
    merged = merge_history(
        state, snapshots.snapshot_rows(deliveries[1]), "cost_code", snapshots.CHECKED, RUNS[1],
        invalidate_hard_deletes=False,
    )
    assert versions(merged, "gone") == [(1.0, 0, None)]


def test_as_of_uses_half_open_intervals(spark, history):
    from plumbline.plans.staging import stg_takeoff_items

    moments = [datetime(2023, 12, 31), datetime(2024, 1, 31, 23), datetime(2024, 2, 1)]
    takeoffs = stg_takeoff_items(
        table(
            spark, "takeoff_items",
            *[dict(cost_code="priced", created_at=moment) for moment in moments],
            dict(cost_code="gone", created_at=datetime(2024, 2, 15)),
            dict(cost_code="unknown", created_at=datetime(2024, 2, 15)),
        )
    )
    priced = snapshots.priced_as_of(takeoffs, history)
    rows = {row["takeoff_id"]: row["unit_cost_mid"] for row in priced.collect()}
    assert rows == {1: None, 2: 2.0, 3: 3.0, 4: None, 5: None}


def test_price_changes(history):
    rows = snapshots.price_changes(history).where("cost_code = 'priced'").orderBy("valid_from")
    assert [(row["version_number"], row["change_pct"]) for row in rows.collect()] == [
        (1, None), (2, 50.0),
    ]


def test_stored_runs_can_be_repeated(spark, deliveries, tmp_path, history):
    store = TableStore(spark, str(tmp_path))
    for run, rows in zip(RUNS, [*deliveries, deliveries[2]]):
        stored = stages.snapshot(store, rows, run)
    assert stored.exceptAll(history).count() == 0 and stored.count() == history.count()
    again = stages.snapshot(store, deliveries[2], RUNS[3])
    assert again.exceptAll(history).count() == 0 and again.count() == history.count()
    assert stages.history(store).read().count() == history.count()
    with pytest.raises(ValueError):
        stages.snapshot(store, deliveries[1], RUNS[1])
    # A rerun with another delivery forgets what the first try did.
    other = stages.snapshot(store, deliveries[0], RUNS[3])
    expected = snapshots.initial(deliveries[0], RUNS[0])
    for run, rows in zip(RUNS[1:], [*deliveries[1:], deliveries[0]]):
        expected = snapshots.merged(expected, rows, run)
    assert other.exceptAll(expected).count() == 0 and other.count() == expected.count()


def test_the_first_run_can_be_repeated(spark, deliveries, tmp_path):
    store = TableStore(spark, str(tmp_path))
    stages.snapshot(store, deliveries[0], RUNS[0])
    again = stages.snapshot(store, deliveries[1], RUNS[0])
    expected = snapshots.initial(deliveries[1], RUNS[0])
    assert again.exceptAll(expected).count() == 0 and again.count() == expected.count()


def stored_rows(spark, path):
    """Rows of the closed folders, and of the live open one."""
    closed = spark.read.parquet(f"{path}/closed/*").count()
    last = stages.HistoryStore(spark, path).commits()[-1]["sequence"]
    return closed, spark.read.parquet(f"{path}/open/{last % 2}").where("_closed = 0").count()


def test_storage_grows_by_changes(spark, deliveries, tmp_path, history):
    runs = [*RUNS, "2024-05-01 00:00:00"]
    same, changed = (TableStore(spark, str(tmp_path / name)) for name in ("same", "changed"))
    for run in runs:
        stages.snapshot(same, deliveries[0], run)
    assert stored_rows(spark, same.path(stages.SNAPSHOT)) == (0, deliveries[0].count())
    for run, rows in zip(runs, [*deliveries, deliveries[2], deliveries[2]]):
        stages.snapshot(changed, rows, run)
    still_open = history.where("valid_to IS NULL").count()
    assert stored_rows(spark, changed.path(stages.SNAPSHOT)) == (
        history.count() - still_open, still_open,
    )


def test_a_failed_run_changes_nothing(spark, deliveries, tmp_path):
    store = TableStore(spark, str(tmp_path))
    before = stages.snapshot(store, deliveries[0], RUNS[0]).toPandas()
    broken = costs(spark, same=(2.0, {})).withColumn(
        "unit_cost_mid", F.raise_error(F.lit("lost")).cast("double")
    )
    with pytest.raises(Exception, match="lost"):
        stages.snapshot(store, broken, RUNS[1])
    after = stages.history(store).read().toPandas()
    assert before.sort_values("cost_code").equals(after.sort_values("cost_code"))


def test_an_emptied_library_closes_everything(spark, deliveries, tmp_path):
    store = TableStore(spark, str(tmp_path))
    stages.snapshot(store, deliveries[0], RUNS[0])
    emptied = stages.snapshot(store, deliveries[0].where("false"), RUNS[1])
    assert emptied.count() == emptied.where("valid_to IS NOT NULL").count() == 5
    assert stages.snapshot(store, deliveries[0], RUNS[2]).count() == 10


def test_repeated_codes_are_refused(spark, deliveries, tmp_path):
    store = TableStore(spark, str(tmp_path))
    with pytest.raises(ValueError):
        stages.snapshot(store, deliveries[0].union(deliveries[0]), RUNS[0])
    with pytest.raises(ValueError):
        stages.snapshot(store, costs(spark, a=(1.0, {})).withColumn("cost_code", F.lit(None).cast("string")), RUNS[0])


@pytest.mark.parametrize("hot_rows", [10**6, 300])
def test_as_of_looks_at_each_row_once(spark, hot_rows):
    """One hot code with 1,000 versions: the window sees facts and versions, not their pairs."""
    moment = F.timestamp_seconds(F.col("id") * 10).cast("timestamp_ntz")
    later = F.timestamp_seconds(F.col("id") * 10 + 8).cast("timestamp_ntz")
    history = spark.range(1000).select(
        F.lit("hot").alias("code"), moment.alias("valid_from"), later.alias("valid_to"), F.col("id").alias("price")
    )
    at = F.timestamp_seconds(F.col("id") * 3 - 30).cast("timestamp_ntz")
    facts = spark.range(4000).select(
        "id", F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 == 8, "cold").alias("code"),
        F.when(F.col("id") % 7 > 0, at).alias("at"),
    )
    hot = HotKeys.find(facts.where("at IS NOT NULL"), "code", scratch_keep(spark), "codes", hot_rows)
    assert hot.number == (2 if hot_rows == 300 else 0)
    found = scd.as_of(facts, history, "code", "at", ["price"], hot, hot_rows)
    rows = {r["id"]: r for r in found.collect()}
    assert len(rows) == found.count() == 4000 and found.columns == ["id", "code", "at", "valid_from", "price"]
    for i, row in rows.items():
        second = i * 3 - 30
        known = row["code"] == "hot" and row["at"] is not None and 0 <= second < 10_000 and second % 10 < 8
        assert row["price"] == (second // 10 if known else None)
    # Every version stands once in each line of its code; no join has a time in its condition.
    salts = {r["key"]: -(-r["rows"] // hot_rows) for r in hot.counts.collect()}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert salts.get("hot", 1) == (10 if hot_rows == 300 else 1) and "valid_from" not in "".join(
        line for line in plan.split("\n") if "Join" in line
    )
