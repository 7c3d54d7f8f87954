"""Small hand-written raw tables."""

from datetime import date, datetime

import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema

from plumbline.schemas import raw_schema

DAY = date(2024, 3, 1)
NOON = datetime(2024, 3, 1, 12, 0, 0)

DEFAULTS = {
    "projects": dict(
        project_id=1, client_name="Client", project_name="Tower", project_type="commercial",
        location_state="ca", bid_date=DAY, plan_set_version="v1.0", status="pending",
        created_at=NOON,
    ),
    "blueprint_pages": dict(
        page_id=1, project_id=1, sheet_number="A01", discipline="A", page_title="Plan",
        image_path="/a.pdf", page_version=1, created_at=NOON,
    ),
    "cost_library": dict(
        cost_code="03-FOOT", division="03", division_name="Concrete", item_type="footing",
        uom="CY", unit_cost_low=75.0, unit_cost_mid=100.0, unit_cost_high=135.0, last_updated=DAY,
    ),
    "takeoff_items": dict(
        takeoff_id=1, project_id=1, page_id=1, cost_code="03-FOOT", item_type="footing",
        quantity=10.0, uom="CY", confidence=0.95, extraction_method="ai", created_at=NOON,
    ),
    "estimates": dict(
        estimate_id=1, project_id=1, estimate_version=1, estimate_total_low=900.0,
        estimate_total_mid=1000.0, estimate_total_high=1400.0, generated_at=NOON,
        estimation_method="ai",
    ),
    "estimate_line_items": dict(
        line_item_id=1, estimate_id=1, cost_code="03-FOOT", item_type="footing", quantity=10.0,
        uom="CY", unit_cost_mid=100.0, extended_cost_mid=1000.0,
    ),
    "qa_reviews": dict(
        review_id=1, project_id=1, page_id=None, takeoff_id=None, issue_type="duplicate",
        severity="low", resolved=True, reviewed_at=NOON,
    ),
}
KEYS = {
    "projects": "project_id", "blueprint_pages": "page_id", "cost_library": "cost_code",
    "takeoff_items": "takeoff_id", "estimates": "estimate_id",
    "estimate_line_items": "line_item_id", "qa_reviews": "review_id",
}


def table(spark, name, *rows):
    """Rows of a raw table; what a row leaves out is filled in, keys count up."""
    schema = raw_schema(name)
    filled = []
    for number, row in enumerate(rows, start=1):
        values = {**DEFAULTS[name], **row}
        if KEYS[name] not in row and name != "cost_library":
            values[KEYS[name]] = number
        filled.append({column: values[column] for column in schema.names})
    return spark.createDataFrame(pa.Table.from_pylist(filled, to_arrow_schema(schema)), schema)


def by(frame, key):
    return {row[key]: row for row in frame.collect()}
