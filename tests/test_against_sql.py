"""Every registered query against its SQL on the smallest test tables."""

import __spark_entry__ as entry_points
import pytest
from compare import connect, difference, rows_of

from plumbline import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) <= set(entry_points.queries())
    assert set(catalog.QUERIES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, connection, name):
    frame = entry_points.queries()[name](spark, FOLDER)
    assert difference(frame, connection, entry_points.oracle_sql()[name]) is None
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ObjectHashAggregate(keys=[], functions=[percentile"):
        assert slow not in plan


def test_offences_are_found(connection):
    """The disputed tables have orphans, bad quantities and confidences, and wrong units."""
    sql = entry_points.oracle_sql()

    def rows(name, where):
        return connection.execute(f"SELECT count(*) FROM ({sql[name]}) WHERE {where}").fetchone()[0]

    assert rows("dq_orphans_disputed", "missing_key IS NOT NULL") > 0
    assert rows("dq_positive_quantities_disputed", "quantity < 0") > 0
    assert rows("dq_valid_confidence_disputed", "confidence > 1") > 0
    assert rows("dq_relationships_disputed", "NOT passed") == 2
    assert rows("dq_checks_summary_disputed", "NOT passed") >= 3
    assert rows("check_valid_quantities_disputed", "NOT passed") == 1
    assert rows("stg_estimate_line_items_disputed", "cost_impact = 'Major'") > 0
    assert rows("stg_qa_reviews_disputed", "issue_type = 'wrong_uom'") > 0


def test_comparison_sees_a_changed_value(spark, connection):
    frame = entry_points.queries()["rpt_counts"](spark, FOLDER)
    changed = entry_points.oracle_sql()["rpt_counts"].replace("count(*)", "count(*) + 1", 1)
    assert "missing" in difference(frame, connection, changed)
    assert rows_of(["a", "b"], [(1, 2.0)]) == rows_of(["b", "a"], [(2, 1.0)])


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.count() == 150
    assert "readiness_status" in frame.columns
