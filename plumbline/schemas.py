"""Schemas of the seven raw tables.

Read explicitly, never inferred: inference would turn a division code such as
``03`` into the integer 3.
"""

from __future__ import annotations

from pyspark.sql import types as T



_DDL = {
    "projects": """
        project_id bigint, client_name string, project_name string, project_type string,
        location_state string, bid_date date, plan_set_version string, status string,
        created_at timestamp_ntz""",
    "blueprint_pages": """
        page_id bigint, project_id bigint, sheet_number string, discipline string,
        page_title string, image_path string, page_version bigint, created_at timestamp_ntz""",
    "cost_library": """
        cost_code string, division string, division_name string, item_type string, uom string,
        unit_cost_low double, unit_cost_mid double, unit_cost_high double, last_updated date""",
    "takeoff_items": """
        takeoff_id bigint, project_id bigint, page_id bigint, cost_code string, item_type string,
        quantity double, uom string, confidence double, extraction_method string,
        created_at timestamp_ntz""",
    "estimates": """
        estimate_id bigint, project_id bigint, estimate_version bigint,
        estimate_total_low double, estimate_total_mid double, estimate_total_high double,
        generated_at timestamp_ntz, estimation_method string""",
    "estimate_line_items": """
        line_item_id bigint, estimate_id bigint, cost_code string, item_type string,
        quantity double, uom string, unit_cost_mid double, extended_cost_mid double""",
    "qa_reviews": """
        review_id bigint, project_id bigint, page_id bigint, takeoff_id bigint,
        issue_type string, severity string, resolved boolean, reviewed_at timestamp_ntz""",
}

RAW_TABLES = tuple(_DDL)


def raw_columns(table: str) -> dict[str, str]:
    """Column names of a raw table with their types."""
    return dict(entry.split() for entry in _DDL[table].split(","))


def raw_schema(table: str, **overrides: str) -> T.StructType:
    """Schema of a raw table; ``overrides`` replace column types (``takeoff_id="string"``)."""
    columns = {**raw_columns(table), **overrides}
    return T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in columns.items()))
