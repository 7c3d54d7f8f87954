"""Edge rows of facts, marts, checks and roll-ups."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import by, table

from plumbline import catalog
from plumbline.plans import dashboards, marts, quality, reports, rollups, staging
from plumbline.sources.tables import scratch_keep


@pytest.fixture(scope="module")
def build(spark):
    def frames(**given):
        staged = {}
        for name in (
            "projects", "blueprint_pages", "cost_library", "takeoff_items", "estimates",
            "estimate_line_items", "qa_reviews",
        ):
            rows = given.get(name, [{}])
            staged[name] = getattr(staging, f"stg_{name}")(table(spark, name, *rows))
        return staged

    return frames


def dashboard(s):
    return marts.mart_estimation_dashboard(
        s["projects"],
        s["blueprint_pages"],
        marts.takeoffs_by_project(s["takeoff_items"]),
        s["estimates"],
        s["qa_reviews"],
    )


def facts(s):
    return marts.fct_takeoffs(
        s["takeoff_items"], s["blueprint_pages"], s["projects"], s["cost_library"]
    )


def estimates(s):
    return marts.fct_estimates(
        s["estimates"],
        s["projects"],
        s["estimate_line_items"],
        marts.takeoffs_by_project(s["takeoff_items"]),
    )


def test_project_without_anything(build):
    row = by(dashboard(build(projects=[{}, {}])), "project_id")[2]
    assert (row["page_count"], row["takeoff_count"], row["estimate_version"]) == (0, 0, 0)
    assert row["pct_ai_extracted"] is None and row["pct_low_confidence"] is None
    assert row["latest_estimate_id"] is None
    assert (row["readiness_status"], row["confidence_level"]) == ("No Estimate", "Low")
    assert row["completeness_score"] == 0 and row["estimate_range"] == 0


@pytest.mark.parametrize(("low_items", "status"), [(5, "Ready"), (6, "Needs Review")])
def test_readiness_turns_on_the_sixth_low_item(build, low_items, status):
    items = [dict(confidence=0.5)] * low_items + [dict(confidence=0.99)] * 20
    row = by(dashboard(build(takeoff_items=items)), "project_id")[1]
    assert row["avg_confidence"] >= 0.8 and row["readiness_status"] == status


def test_readiness_order_and_unresolved_reviews(build):
    s = build(
        projects=[{}] * 4,
        takeoff_items=[dict(project_id=1), dict(project_id=2), dict(project_id=3, confidence=0.7)],
        estimates=[dict(project_id=n) for n in (1, 2, 3)]
        + [dict(project_id=4, estimate_total_mid=0.0)],
        qa_reviews=[
            dict(project_id=1, resolved=None), dict(project_id=2, resolved=False),
            dict(project_id=4, resolved=False),
        ],
    )
    rows = by(dashboard(s), "project_id")
    assert [rows[n]["readiness_status"] for n in (1, 2, 3, 4)] == [
        "Ready", "Needs Review", "In Progress", "No Estimate",
    ]
    assert rows[1]["open_qa_issues"] == 0 and rows[1]["total_qa_issues"] == 1


def test_latest_version_wins_and_ties_go_to_the_higher_id(build):
    s = build(
        estimates=[
            dict(estimate_version=2, estimate_total_mid=5.0),
            dict(estimate_version=2, estimate_total_mid=7.0),
            dict(estimate_version=1, estimate_total_mid=9.0),
        ]
    )
    assert by(dashboard(s), "project_id")[1]["estimate_total_mid"] == Decimal("7.00")


def test_orphans_leave_the_fact(build):
    s = build(
        takeoff_items=[{}, dict(page_id=9), dict(project_id=9), dict(cost_code="none")],
        blueprint_pages=[dict(project_id=77)],
    )
    rows = by(facts(s), "takeoff_id")
    assert set(rows) == {1}
    # The takeoff's project counts, not that of its page.
    assert rows[1]["project_id"] == 1 and rows[1]["line_total"] == Decimal("1000.00")


def test_reviews_repeat_on_each_discipline(build):
    s = build(
        blueprint_pages=[dict(discipline="A"), dict(discipline="S")],
        takeoff_items=[dict(page_id=1), dict(page_id=1), dict(page_id=2, confidence=0.5)],
        qa_reviews=[dict(resolved=False, severity="high")] + [{}] * 3,
    )
    mart = marts.mart_takeoff_quality_monitoring(
        s["takeoff_items"], s["blueprint_pages"], s["projects"], s["qa_reviews"]
    )
    rows = by(mart, "discipline")
    assert rows["A"]["total_qa_issues"] == rows["S"]["total_qa_issues"] == 4
    assert rows["A"]["issue_rate_per_100"] == 200.0 and rows["S"]["issue_rate_per_100"] == 400.0
    assert rows["A"]["quality_tier"] == "Excellent" and rows["S"]["quality_tier"] == "Needs Review"
    assert rows["A"]["requires_attention"] and rows["A"]["avg_issue_severity"] == 1.5


def test_estimates_without_lines_or_takeoffs(build):
    s = build(
        projects=[{}, {}],
        estimates=[{}, dict(project_id=2, estimate_total_mid=0.0)],
        takeoff_items=[dict(confidence=0.5), {}],
    )
    rows = by(estimates(s), "estimate_id")
    assert rows[1]["pct_low_confidence"] == 50.0 and rows[1]["estimate_variance_pct"] == 0.0
    assert rows[2]["pct_low_confidence"] == 0.0 and rows[2]["estimate_variance_pct"] == 0.0
    assert rows[2]["line_item_count"] == 0 and rows[2]["is_zero_estimate"]
    assert rows[2]["avg_takeoff_confidence"] == 0.0


def test_share_of_a_zero_estimate_is_zero(build):
    s = build(estimates=[dict(estimate_total_mid=0.0)])
    mart = marts.mart_estimate_cost_breakdown(
        s["estimate_line_items"], s["estimates"], s["projects"], s["cost_library"]
    )
    row = mart.first()
    assert row["pct_of_estimate"] == 0.0 and row["extended_cost_low"] == Decimal("750.00")


def test_checks_over_an_empty_fact(build):
    empty = facts(build()).where("false")
    amounts = quality.check_valid_quantities(empty).first()
    assert amounts["invalid_quantities"] is None
    assert not amounts["passed"] and amounts["severity"] == "ERROR"
    confidence = quality.check_confidence_distribution(empty).first()
    assert confidence["passed"] and confidence["pct_low_confidence"] == 0.0


def test_checks_find_planted_faults(build):
    s = build(
        projects=[dict(project_name=f"P{n}") for n in range(1, 6)],
        takeoff_items=[
            dict(project_id=n, confidence=0.5, quantity=quantity)
            for n, quantity in zip(range(1, 6), (1.0, 0.0, -1.0, 1.0, 1.0))
        ]
        + [dict(confidence=1.2), dict(confidence=-0.1)],
        estimates=[dict(estimate_total_mid=0.0), dict(estimate_total_mid=None), {}],
    )
    fact = facts(s)
    assert {row["takeoff_id"] for row in quality.positive_quantities(s["takeoff_items"]).collect()} == {2, 3}
    assert {row["takeoff_id"] for row in quality.valid_confidence(s["takeoff_items"]).collect()} == {6, 7}
    rows = by(quality.checks_summary(fact, estimates(s), dashboard(s)), "check")
    assert rows["invalid_quantities"]["value"] == 2 and rows["invalid_confidence"]["value"] == 2
    assert rows["zero_estimates"]["value"] == 2
    assert rows["projects_with_high_low_confidence"]["value"] == 5
    assert rows["projects_with_high_low_confidence"]["issue"].endswith("first: P1, P2, P3")
    assert rows["all"]["value"] == 4 and rows["all"]["passed"] is False
    assert rows["total_takeoffs"]["passed"] is None


def test_rounded_confidence_decides_in_checks(build):
    # Staged as low from the raw 0.5996, but 0.600 is not low to the checks.
    s = build(takeoff_items=[dict(confidence=0.5996)])
    assert by(dashboard(s), "project_id")[1]["low_confidence_count"] == 1
    assert reports.takeoff_stats(facts(s)).first()["low_confidence_count"] == 0


def test_rollups(spark, build):
    s = build(
        projects=[{}, {}],
        cost_library=[{}, dict(cost_code="B", unit_cost_low=1.0, unit_cost_mid=2.0, unit_cost_high=3.0)],
        takeoff_items=[
            dict(quantity=2.0), dict(quantity=3.5), dict(quantity=10.0, cost_code="B"),
            dict(quantity=99.0, cost_code="unpriced"),
        ],
    )
    versions = spark.createDataFrame(
        [(1, 1, 1, 0.1), (2, 1, 3, 0.1), (3, 2, 1, 0.0)],
        "estimate_id bigint, project_id bigint, estimate_version bigint, version_rate double",
    )
    rows = by(
        rollups.estimate_rollup(versions, s["takeoff_items"], s["cost_library"]), "estimate_id"
    )
    assert rows[1]["estimate_total_mid"] == 570.0
    assert rows[1]["estimate_total_low"] == round((5.5 * 75 + 10) * 0.95, 2)
    assert rows[2]["estimate_total_mid"] == 684.0
    assert rows[3]["estimate_total_mid"] == 0.0
    lines = by(
        rollups.estimate_line_item_rollup(versions, s["takeoff_items"], s["cost_library"], scratch_keep(spark)).where(
            "estimate_id = 2"
        ),
        "cost_code",
    )
    assert set(lines) == {"03-FOOT", "B"}
    assert lines["03-FOOT"]["extended_cost_mid"] == Decimal("550.00")


def test_keys(spark):
    row = spark.range(1).select(
        rollups.cost_code_key(F.lit("03"), F.lit("footing")).alias("code"),
        rollups.sheet_key(F.lit("A"), F.lit(7)).alias("sheet"),
        rollups.sheet_key(F.lit("A"), F.lit(107)).alias("long_sheet"),
    ).first()
    assert tuple(row) == ("03-FOOT", "A07", "A107")


def test_dashboard_lists(build):
    s = build(
        projects=[dict(project_name=f"P{n}") for n in range(1, 8)],
        estimates=[dict(project_id=n, estimate_total_mid=1e6 * n) for n in range(1, 8)],
        qa_reviews=[dict(project_id=n, resolved=False) for n in range(1, 8)],
    )
    listed = dashboards.attention_projects(dashboard(s)).collect()
    assert [row["project_name"] for row in listed] == ["P7", "P6", "P5", "P4", "P3"]
    recent = dashboards.recent_activity(estimates(s), s["projects"]).collect()
    assert [row["project_name"] for row in recent] == ["P1", "P2", "P3", "P4"]
    assert {row["method_label"] for row in recent} == {"AI"}


def _odd_tables(spark, folder):
    """Test tables with repeated and missing keys, and takeoffs without page, project or price."""
    from plumbline.sources.driver_tables import SCHEMAS

    rows = {
        "customer": "VALUES (0, 'a', 0, 'BUILDING'), (1, 'b', 0, 'AUTOMOBILE'), (1, 'b2', 0, 'x'), (NULL, 'n', 0, 'x')",
        "nation": "VALUES (0, 'utopia')",
        "orders": """SELECT k, c, 'F', 100.0, TIMESTAMP_NTZ '1996-01-01 00:00:00', '1-URGENT'
            FROM VALUES (0, 0), (1, 1), (2, 1), (2, 0), (3, 77), (NULL, 0) AS t(k, c)""",
        "lineitem": """SELECT o, p, s, 1, 2.0, 0.05, f, TIMESTAMP_NTZ '1996-01-01 00:00:00' FROM VALUES
            (0, 0, 5, 'A'), (0, 0, 5, 'A'), (1, 1, 5, 'N'), (2, 1, NULL, 'R'), (2, 9, 5, 'A'), (3, 0, 5, 'A'),
            (8, 0, 5, 'A'), (NULL, 0, 5, 'A'), (1, NULL, 5, 'A') AS t(o, p, s, f)""",
        "part": "VALUES (0, 'bolt', 'Brand#1', 't', 1, 10.0), (1, 'nut', 'Brand#2', 't', 2, 20.0), (1, 'nut2', 'Brand#2', 't', 3, 30.0)",
        "events": "VALUES (0, TIMESTAMP_NTZ '1996-01-01 00:00:00', 0, 'view', 1.0)",
    }
    for name, query in rows.items():
        found = spark.sql(query)
        schema = spark.createDataFrame([], SCHEMAS[name]).schema
        found = found.toDF(*schema.names)
        found.select(*[found[f.name].cast(f.dataType).alias(f.name) for f in schema]).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_takeoffs_meet_their_project_by_page(spark, tmp_path):
    """Two shuffles of the takeoffs, as many rows as by joins one after another, from stored buckets too."""
    folder = _odd_tables(spark, tmp_path / "odd")
    w = catalog.Warehouse(spark, folder)
    t = w.table
    plain = marts.fct_takeoffs(
        t("stg_takeoff_items"), t("stg_blueprint_pages"), t("stg_projects"), t("stg_cost_library")
    ).drop(marts.UPDATED_AT)
    # 2 takeoffs of page 0; page 1: 2 projects x 2 items x 2 prices; page 2: 2 pages x 3 projects x 4.
    assert plain.count() == 2 + 8 + 24
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for made in (t("fct_takeoffs"), w.priced_takeoffs, w.colocated_fact):
        made = made.drop(marts.UPDATED_AT)
        assert made.columns == plain.columns
        assert made.exceptAll(plain).count() == 0 and plain.exceptAll(made).count() == 0
    # By page: takeoffs, pages and owners; by code: takeoffs, items and prices; by project: owners and projects.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    plan = t("fct_takeoffs")._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_project = [line for line in plan.splitlines() if "Exchange hashpartitioning(project_id" in line]
    assert len(by_project) <= 2 and "l_quantity" in plan


def test_report_and_tests_store_what_they_read_more_than_once(spark, tmp_path):
    folder = _odd_tables(spark, tmp_path / "odd")
    tests = catalog._for_tests(catalog.Warehouse(spark, folder))
    report = catalog._for_report(catalog.Warehouse(spark, folder, catalog.DisputedTables))
    assert isinstance(report.raw, catalog.DisputedTables)
    for frame in (tests.table("raw.takeoff_items"), tests.table("raw.estimates"), report.table("fct_takeoffs"), report.takeoff_totals):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan
    whole = catalog.Warehouse(spark, folder, catalog.DisputedTables).checks
    assert sorted(map(str, report.checks.collect())) == sorted(map(str, whole.collect()))
