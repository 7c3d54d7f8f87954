"""Queries over tables with repeated lookup keys still equal their SQL."""

import shutil
from pathlib import Path

import __spark_entry__ as entry_points
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from compare import connect, difference

SOURCE = Path("/root/testdata/sf0.001")
NAMES = [
    "load_audit", "fct_estimates", "mart_takeoff_quality_monitoring", "mart_estimation_dashboard",
    "agg_method_mix", "estimate_rollup", "dq_unique", "dq_test_results", "dq_orphans",
    "dq_checks_summary", "check_valid_quantities", "rpt_takeoff_stats", "adhoc_top_cost_codes",
    "dash_ai_performance",
]


@pytest.fixture(scope="module", params=["part", "orders"])
def folder(request, tmp_path_factory):
    path = tmp_path_factory.mktemp(f"repeated-{request.param}")
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        shutil.copyfile(SOURCE / f"{name}.parquet", path / f"{name}.parquet")
    rows = pq.read_table(SOURCE / f"{request.param}.parquet")
    pq.write_table(pa.concat_tables([rows, rows.slice(0, 3)]), path / f"{request.param}.parquet")
    return str(path)


@pytest.mark.parametrize("name", NAMES)
def test_repeated_keys(spark, folder, name):
    frame = entry_points.queries()[name](spark, folder)
    assert difference(frame, connect(folder), entry_points.oracle_sql()[name]) is None
