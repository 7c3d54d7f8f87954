"""The four stages of a full refresh, each over stored tables of the one before.

Storing raw tables and marts keeps every stage short, lets a lost executor
redo one stage's tasks only, and gives the later joins file sizes to plan by.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumbline.operators import data_tests
from plumbline.operators.colocated import colocate
from plumbline.operators.salting import HotKeys
from plumbline.operators.value_histogram import ValueHistogram
from plumbline.plans import marts, quality, reports, snapshots, staging
from plumbline.session import side_by_side
from plumbline.sources import raw_csv
from plumbline.sources.history_store import HistoryStore
from plumbline.sources.tables import TableStore, load_audit

STAGING = {
    "projects": staging.stg_projects,
    "blueprint_pages": staging.stg_blueprint_pages,
    "cost_library": staging.stg_cost_library,
    "takeoff_items": staging.stg_takeoff_items,
    "estimates": staging.stg_estimates,
    "estimate_line_items": staging.stg_estimate_line_items,
    "qa_reviews": staging.stg_qa_reviews,
}
ESTIMATE_TOTALS = "estimate_totals"
SNAPSHOT = "snapshots.cost_library_snapshot"


def table(store: TableStore, name: str) -> DataFrame:
    """A stored raw table or mart, or a staging view over its raw table."""
    if name.startswith("stg_"):
        raw = name.removeprefix("stg_")
        return STAGING[raw](raw_table(store, raw))
    if name.startswith("raw."):
        return raw_table(store, name.removeprefix("raw."))
    return store.read(name)


def extract(raw: Mapping[str, DataFrame], csv_folder: str) -> None:
    if raw:
        spark = next(iter(raw.values())).sparkSession
        side_by_side(spark, lambda name: raw_csv.write_csv(raw[name], csv_folder, name), raw)


def load(
    spark: SparkSession,
    csv_folder: str,
    store: TableStore,
    overrides: dict[str, dict[str, str]] | None = None,
    strict: bool = False,
) -> DataFrame:
    """CSV to raw tables; returns the audit. Tables without a file are left alone.

    Lines that do not fit their table are kept beside it with the reasons
    (``rejects``) and counted in the audit; with ``strict`` the first one stops
    the load. The counts come from the writes themselves. Unless ``strict``, the
    tables are written side by side.
    """
    reader = raw_csv.read_csv if strict else raw_csv.read_checked
    tables = raw_csv.read_all(spark, csv_folder, overrides, reader)

    def write(name: str) -> tuple[int, int]:
        store.replace(f"raw.{name}", tables[name], apart=None if strict else F.size(raw_csv.REASONS) > 0)
        found = store.measures(f"raw.{name}").first()
        return found["row_count"], 0 if strict else found["apart_count"]

    written = map(write, tables) if strict else side_by_side(spark, write, tables)
    counts = dict(zip(tables, written))
    return store.replace("load_audit", load_audit(spark, counts))


def raw_table(store: TableStore, name: str) -> DataFrame:
    """The good lines of a raw table."""
    return store.read(f"raw.{name}").drop(raw_csv.LINE, raw_csv.REASONS)


def rejects(store: TableStore, name: str) -> DataFrame:
    """Lines of a raw table that did not fit: (line, reasons)."""
    apart = store.read_apart(f"raw.{name}")
    if raw_csv.LINE not in apart.columns:
        return store.spark.createDataFrame([], "line string, reasons array<string>")
    return apart.select(F.col(raw_csv.LINE).alias("line"), F.col(raw_csv.REASONS).alias("reasons"))


def _buckets(store: TableStore, buckets: int | None) -> int:
    return buckets or min(int(store.spark.conf.get("spark.sql.shuffle.partitions")), 100_000)


def by_page(
    store: TableStore, takeoffs: DataFrame, pages: DataFrame, buckets: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Raw takeoffs and pages stored in buckets of the page, staged as they are read.

    One shuffle of the takeoffs serves every join with their pages. The buckets
    number as many as shuffle partitions unless given; Spark allows 100,000.
    """
    takeoffs, pages = colocate(
        store,
        ("colocated.takeoff_items", takeoffs),
        ("colocated.blueprint_pages", pages),
        "page_id",
        F.col("takeoff_id"),
        _buckets(store, buckets),
    )
    return staging.stg_takeoff_items(takeoffs), staging.stg_blueprint_pages(pages)


def lines_by_page(
    store: TableStore,
    lines: DataFrame,
    spread_by: Column,
    pages: DataFrame,
    owners: DataFrame,
    buckets: int | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Like ``by_page`` for takeoffs whose project is still to be looked up: the lines, the staged pages and their owners."""
    lines, pages, owners = colocate(
        store,
        ("colocated.takeoff_lines", lines),
        ("colocated.blueprint_pages", pages),
        "page_id",
        spread_by,
        _buckets(store, buckets),
        further=[("colocated.page_owners", owners)],
    )
    return lines, staging.stg_blueprint_pages(pages), owners


def transform(store: TableStore, run_time: str, buckets: int | None = None) -> None:
    """Facts, marts and the price history."""

    def stg(name: str) -> DataFrame:
        return table(store, f"stg_{name}")

    takeoffs, pages, projects = stg("takeoff_items"), stg("blueprint_pages"), stg("projects")
    costs, estimates = stg("cost_library"), stg("estimates")
    lines, reviews = stg("estimate_line_items"), stg("qa_reviews")
    paged_takeoffs, takeoff_pages = by_page(
        store, raw_table(store, "takeoff_items"), raw_table(store, "blueprint_pages"), buckets
    )
    facts = marts.fct_takeoffs(paged_takeoffs, takeoff_pages, projects, costs)
    store.replace("fct_takeoffs", facts, quality.takeoff_measures())
    totals = store.replace("takeoffs_by_project", marts.takeoffs_by_project(takeoffs))
    hot = HotKeys.find(estimates, "project_id", store.keep, "hot_keys.estimates_by_project")
    facts = marts.fct_estimates(estimates, projects, lines, totals, hot)
    facts = store.replace("fct_estimates", facts, quality.estimate_measures())
    ValueHistogram.build(facts, "estimate_total_mid", store.keep, ESTIMATE_TOTALS)
    store.replace(
        "mart_estimate_cost_breakdown",
        marts.mart_estimate_cost_breakdown(lines, estimates, projects, costs),
    )
    store.replace(
        "mart_takeoff_quality_monitoring",
        marts.mart_takeoff_quality_monitoring(paged_takeoffs, takeoff_pages, projects, reviews),
    )
    store.replace(
        "mart_estimation_dashboard",
        marts.mart_estimation_dashboard(projects, pages, totals, estimates, reviews),
        quality.dashboard_measures(),
    )
    snapshot(store, raw_table(store, "cost_library"), run_time)


def snapshot(store: TableStore, raw_costs: DataFrame, run_time: str) -> DataFrame:
    """Add a run to the price history; running the last one again gives the same history.

    The open versions are read from and written to storage, so a merge never
    plans the runs before it again, and closed versions are not touched.
    """
    unusable = data_tests.unusable_keys(raw_costs, snapshots.KEY).first()
    if unusable["repeated"] or unusable["missing"]:
        raise ValueError("the cost library has repeated or missing cost codes")
    stored = history(store)
    open_rows = stored.open_before(run_time)
    if open_rows is None:
        return stored.add(run_time, snapshots.initial(raw_costs, run_time))
    return stored.add(run_time, snapshots.merged_open(open_rows, raw_costs, run_time))


def history(store: TableStore) -> HistoryStore:
    return HistoryStore(store.spark, store.path(SNAPSHOT))


def estimate_totals(store: TableStore) -> ValueHistogram:
    """The histogram of the estimates' mid totals, as the last transform left it."""
    return ValueHistogram.of(store.read(ESTIMATE_TOTALS), store.measures(f"{ESTIMATE_TOTALS}_counts").first())


def check(store: TableStore) -> DataFrame:
    """Declared tests and warehouse checks; failures are rows, the run goes on.

    The tests read each table once; the checks read what was measured while the
    facts were written, and of the dashboard the first offenders.
    """
    store.replace("dq_test_results", quality.test_results(lambda name: table(store, name)))
    return store.replace(
        "dq_checks_summary",
        quality.checks_of(
            store.measures("fct_takeoffs"),
            store.measures("fct_estimates"),
            store.measures("mart_estimation_dashboard"),
            store.read("mart_estimation_dashboard"),
        ),
    )


def publish(store: TableStore) -> DataFrame:
    """The report in long form, with the verdict of the stored checks."""
    return store.replace(
        "rpt_summary",
        reports.summary(
            table(store, "stg_projects"),
            table(store, "stg_blueprint_pages"),
            store.read("fct_takeoffs"),
            estimate_totals(store),
            table(store, "stg_qa_reviews"),
            store.read("mart_estimation_dashboard"),
            store.read("dq_checks_summary"),
        ),
    )


def run_all(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    csv_folder: str,
    store: TableStore,
    run_time: str,
    overrides: dict[str, dict[str, str]] | None = None,
) -> DataFrame:
    extract(raw, csv_folder)
    load(spark, csv_folder, store, overrides)
    transform(store, run_time)
    check(store)
    return publish(store)
