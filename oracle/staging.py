"""Staged rows. Each statement reads raw columns, qualified where an output has the same name."""


def _spread(prefix: str) -> str:
    return (
        f"round((r.{prefix}_high - r.{prefix}_low) / nullif(r.{prefix}_mid, 0) * 100, 2)"
    )


def _costs(prefix: str, digits: int) -> str:
    return ", ".join(
        f"CAST(r.{prefix}_{level} AS DECIMAL({digits}, 2)) AS {prefix}_{level}"
        for level in ("low", "mid", "high")
    )


TABLES = {
    "stg_projects": f"""
        SELECT r.* EXCLUDE (status) REPLACE (upper(r.location_state) AS location_state),
            r.status AS project_status,
            CASE r.project_type
                WHEN 'residential' THEN 'Residential'
                WHEN 'commercial' THEN 'Commercial'
                WHEN 'industrial' THEN 'Industrial'
                WHEN 'mixed_use' THEN 'Mixed Use'
                ELSE 'Other' END
                AS project_type_display
        FROM raw_projects r""",
    "stg_blueprint_pages": f"""
        SELECT r.* REPLACE (upper(r.discipline) AS discipline),
            CASE r.discipline
                WHEN 'A' THEN 'Architectural'
                WHEN 'S' THEN 'Structural'
                WHEN 'C' THEN 'Civil'
                WHEN 'M' THEN 'Mechanical'
                WHEN 'E' THEN 'Electrical'
                WHEN 'P' THEN 'Plumbing'
                ELSE 'Unknown' END
                AS discipline_name
        FROM raw_blueprint_pages r""",
    "stg_cost_library": f"""
        SELECT r.* EXCLUDE (unit_cost_low, unit_cost_mid, unit_cost_high), {_costs("unit_cost", 12)},
            {_spread("unit_cost")} AS cost_variance_pct,
            CASE
                WHEN r.unit_cost_mid < CAST(50.0 AS DOUBLE) THEN 'Low Cost'
                WHEN r.unit_cost_mid < CAST(200.0 AS DOUBLE) THEN 'Medium Cost'
                ELSE 'High Cost' END AS cost_tier
        FROM raw_cost_library r""",
    "stg_takeoff_items": f"""
        SELECT r.* EXCLUDE (quantity, confidence),
            CAST(r.quantity AS DECIMAL(12, 2)) AS quantity,
            CAST(r.confidence AS DECIMAL(5, 3)) AS confidence,
            CASE
                WHEN r.confidence >= CAST(0.9 AS DOUBLE) THEN 'High'
                WHEN r.confidence >= CAST(0.75 AS DOUBLE) THEN 'Medium'
                WHEN r.confidence >= CAST(0.6 AS DOUBLE) THEN 'Low'
                ELSE 'Very Low' END
                AS confidence_tier,
            ifnull(r.confidence < CAST(0.6 AS DOUBLE), false)
                AS is_low_confidence,
            CASE r.extraction_method
                WHEN 'ai' THEN 'AI Extracted'
                WHEN 'manual' THEN 'Manual Entry'
                WHEN 'hybrid' THEN 'AI + Manual Review'
                ELSE 'Unknown' END
                AS extraction_method_display
        FROM raw_takeoff_items r""",
    "stg_estimates": f"""
        SELECT r.* EXCLUDE (estimate_total_low, estimate_total_mid, estimate_total_high),
            {_costs("estimate_total", 14)},
            {_spread("estimate_total")} AS estimate_range_pct,
            CASE
                WHEN r.estimate_total_mid < CAST(100000.0 AS DOUBLE) THEN 'Small'
                WHEN r.estimate_total_mid < CAST(500000.0 AS DOUBLE) THEN 'Medium'
                WHEN r.estimate_total_mid < CAST(2000000.0 AS DOUBLE) THEN 'Large'
                ELSE 'Enterprise' END
                AS estimate_size,
            CASE r.estimation_method
                WHEN 'ai' THEN 'AI Generated'
                WHEN 'manual' THEN 'Manual Estimate'
                WHEN 'hybrid' THEN 'AI + Manual Review'
                ELSE 'Unknown' END
                AS estimation_method_display
        FROM raw_estimates r""",
    "stg_estimate_line_items": f"""
        SELECT r.* EXCLUDE (quantity, unit_cost_mid, extended_cost_mid),
            CAST(r.quantity AS DECIMAL(12, 2)) AS quantity,
            CAST(r.unit_cost_mid AS DECIMAL(12, 2)) AS unit_cost_mid,
            CAST(r.extended_cost_mid AS DECIMAL(14, 2)) AS extended_cost_mid,
            CASE
                WHEN r.extended_cost_mid < CAST(1000.0 AS DOUBLE) THEN 'Minor'
                WHEN r.extended_cost_mid < CAST(10000.0 AS DOUBLE) THEN 'Moderate'
                WHEN r.extended_cost_mid < CAST(50000.0 AS DOUBLE) THEN 'Significant'
                ELSE 'Major' END
                AS cost_impact
        FROM raw_estimate_line_items r""",
    "stg_qa_reviews": f"""
        SELECT r.*,
            CASE r.issue_type
                WHEN 'missing_item' THEN 'Missing Item'
                WHEN 'quantity_mismatch' THEN 'Quantity Mismatch'
                WHEN 'wrong_uom' THEN 'Wrong Unit of Measure'
                WHEN 'duplicate' THEN 'Duplicate Entry'
                WHEN 'low_confidence' THEN 'Low Confidence Score'
                WHEN 'cost_outlier' THEN 'Cost Outlier'
                ELSE 'Other' END AS issue_type_display,
            CASE r.severity
                WHEN 'low' THEN 1
                WHEN 'medium' THEN 2
                WHEN 'high' THEN 3
                WHEN 'critical' THEN 4
                ELSE 0 END AS severity_score,
            ifnull(r.severity IN ('high', 'critical'), false) AS is_critical,
            if(r.resolved, 'Resolved', 'Open') AS status
        FROM raw_qa_reviews r""",
}
