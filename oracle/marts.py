"""Aggregates, facts, marts and the price history."""

# When the price history ran.
RUN_TIMES = [
    "1995-07-01 00:00:00",
    "1997-01-01 00:00:00",
    "1999-01-01 00:00:00",
    "2000-07-01 00:00:00",
]


def _share(part: str, whole: str, digits: int) -> str:
    return (
        f"round(CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0) * 100, {digits})"
    )


_PROJECT = """client_name, project_name, project_type, project_type_display, location_state,
    bid_date, plan_set_version, project_status"""


def _merge(history: str, delivery: str, run_time: str) -> str:
    """History after one delivery, from the three price columns compared null-safe."""
    prices = ("unit_cost_low", "unit_cost_mid", "unit_cost_high")
    same = " AND ".join(f"h.{price} IS NOT DISTINCT FROM d.{price}" for price in prices)
    return f"""
        SELECT h.* REPLACE (
            CASE WHEN h.valid_to IS NULL AND NOT EXISTS (
                SELECT 1 FROM {delivery} d WHERE d.cost_code = h.cost_code AND {same})
            THEN TIMESTAMP '{run_time}' ELSE h.valid_to END AS valid_to)
        FROM {history} h
        UNION ALL BY NAME
        SELECT d.*, {_opening(run_time)}
        FROM {delivery} d
        WHERE NOT EXISTS (
            SELECT 1 FROM {history} h
            WHERE h.valid_to IS NULL AND d.cost_code = h.cost_code AND {same})"""


def _opening(run_time: str) -> str:
    return f"""md5(cost_code || '|{run_time}') AS scd_id,
        TIMESTAMP '{run_time}' AS updated_at, TIMESTAMP '{run_time}' AS valid_from,
        CAST(NULL AS TIMESTAMP) AS valid_to"""


def _tracked(source: str) -> str:
    tiers = """CASE
        WHEN unit_cost_mid < CAST(50.0 AS DOUBLE) THEN 'Low Cost'
        WHEN unit_cost_mid < CAST(200.0 AS DOUBLE) THEN 'Medium Cost'
        ELSE 'High Cost' END"""
    return f"SELECT *, {tiers} AS cost_tier FROM {source}"


TABLES = {
    "page_totals": """
        SELECT project_id, count(*) AS page_count, count(DISTINCT discipline) AS discipline_count
        FROM stg_blueprint_pages GROUP BY project_id""",
    "takeoff_totals": """
        SELECT project_id, count(*) AS takeoffs,
            count(*) FILTER (extraction_method = 'ai') AS ai,
            count(*) FILTER (extraction_method = 'manual') AS manual,
            count(*) FILTER (extraction_method = 'hybrid') AS hybrid,
            avg(confidence) AS mean, min(confidence) AS least, max(confidence) AS most,
            count(*) FILTER (is_low_confidence) AS low
        FROM stg_takeoff_items GROUP BY project_id""",
    "review_totals": """
        SELECT project_id, count(*) AS total_issues,
            count(*) FILTER (NOT resolved) AS open_issues,
            count(*) FILTER (resolved) AS resolved_issues,
            count(*) FILTER (is_critical) AS critical_issues, avg(severity_score) AS avg_severity
        FROM stg_qa_reviews GROUP BY project_id""",
    "line_totals": """
        SELECT estimate_id, count(*) AS line_item_count,
            count(DISTINCT cost_code) AS unique_cost_codes,
            sum(extended_cost_mid) AS calculated_total
        FROM stg_estimate_line_items GROUP BY estimate_id""",
    "newest_estimate": """
        SELECT * FROM stg_estimates
        QUALIFY row_number() OVER (
            PARTITION BY project_id ORDER BY estimate_version DESC, estimate_id DESC) = 1""",
    "fct_takeoffs": f"""
        SELECT t.* EXCLUDE (created_at), t.created_at AS takeoff_created_at,
            c.division, c.division_name, c.unit_cost_low, c.unit_cost_mid, c.unit_cost_high,
            c.cost_tier,
            round(t.quantity * c.unit_cost_low, 2) AS extended_cost_low,
            round(t.quantity * c.unit_cost_mid, 2) AS extended_cost_mid,
            round(t.quantity * c.unit_cost_high, 2) AS extended_cost_high,
            g.sheet_number, g.discipline, g.discipline_name, g.page_title, g.page_version,
            {_PROJECT},
            if(c.unit_cost_mid > 0, round(t.quantity * c.unit_cost_mid, 2), 0) AS line_total,
            ifnull(t.extraction_method = 'ai', false) AS is_ai_extracted,
            ifnull(t.extraction_method = 'manual', false) AS is_manual_entry
        FROM stg_takeoff_items t
        JOIN stg_blueprint_pages g USING (page_id)
        JOIN stg_projects j ON j.project_id = t.project_id
        JOIN stg_cost_library c USING (cost_code)""",
    "fct_estimates": f"""
        SELECT e.*, {_PROJECT},
            ifnull(line_item_count, 0) AS line_item_count,
            ifnull(unique_cost_codes, 0) AS unique_cost_codes,
            ifnull(calculated_total, 0) AS calculated_total,
            ifnull(takeoffs, 0) AS total_takeoff_items,
            round(ifnull(mean, 0), 3) AS avg_takeoff_confidence,
            ifnull(low, 0) AS low_confidence_items,
            ifnull({_share("low", "takeoffs", 2)}, 0) AS pct_low_confidence,
            if(calculated_total > 0,
                {_share("(estimate_total_mid - calculated_total)", "calculated_total", 2)}, 0)
                AS estimate_variance_pct,
            ifnull(estimation_method = 'ai', false) AS is_ai_estimate,
            ifnull(estimate_version = 1, false) AS is_initial_estimate,
            ifnull(estimate_total_mid = 0, false) AS is_zero_estimate
        FROM stg_estimates e
        JOIN stg_projects j USING (project_id)
        LEFT JOIN line_totals USING (estimate_id)
        LEFT JOIN takeoff_totals USING (project_id)""",
    "mart_estimate_cost_breakdown": f"""
        SELECT estimate_id, cost_code, c.division, c.division_name, i.item_type, i.uom, quantity,
            i.unit_cost_mid, extended_cost_mid, cost_impact,
            round(quantity * c.unit_cost_low, 2) AS extended_cost_low,
            round(quantity * c.unit_cost_high, 2) AS extended_cost_high,
            estimate_version, estimation_method, estimate_total_mid,
            if(estimate_total_mid > 0, {_share("extended_cost_mid", "estimate_total_mid", 2)}, 0)
                AS pct_of_estimate,
            project_id, client_name, project_name, project_type, location_state
        FROM stg_estimate_line_items i
        JOIN stg_estimates USING (estimate_id)
        JOIN stg_projects USING (project_id)
        JOIN stg_cost_library c USING (cost_code)""",
    "discipline_totals": """
        SELECT t.project_id, discipline, discipline_name, count(*) AS total_takeoffs,
            count(*) FILTER (extraction_method = 'ai') AS ai_takeoffs,
            count(*) FILTER (extraction_method = 'manual') AS manual_takeoffs,
            count(*) FILTER (extraction_method = 'hybrid') AS hybrid_takeoffs,
            avg(confidence) AS mean, min(confidence) AS min_confidence,
            max(confidence) AS max_confidence,
            count(*) FILTER (is_low_confidence) AS low_confidence_count,
            sum(quantity) AS total_quantity
        FROM stg_takeoff_items t JOIN stg_blueprint_pages g USING (page_id)
        GROUP BY t.project_id, discipline, discipline_name""",
    "mart_takeoff_quality_monitoring": f"""
        SELECT d.* EXCLUDE (mean),
            client_name, project_name, project_type, location_state, project_status,
            {_share("ai_takeoffs", "total_takeoffs", 1)} AS pct_ai_extracted,
            {_share("manual_takeoffs", "total_takeoffs", 1)} AS pct_manual,
            round(mean, 3) AS avg_confidence,
            {_share("low_confidence_count", "total_takeoffs", 1)} AS pct_low_confidence,
            ifnull(total_issues, 0) AS total_qa_issues, ifnull(open_issues, 0) AS open_qa_issues,
            ifnull(resolved_issues, 0) AS resolved_qa_issues,
            ifnull(critical_issues, 0) AS critical_qa_issues,
            round(ifnull(avg_severity, 0), 2) AS avg_issue_severity,
            {_share("ifnull(total_issues, 0)", "total_takeoffs", 2)} AS issue_rate_per_100,
            CASE WHEN mean >= 0.85 AND low_confidence_count = 0
                    THEN 'Excellent'
                WHEN mean >= 0.75 THEN 'Good'
                WHEN mean >= 0.65 THEN 'Acceptable'
                ELSE 'Needs Review' END AS quality_tier,
            ifnull(open_issues > 5 OR critical_issues > 0, false)
                AS requires_attention
        FROM discipline_totals d
        JOIN stg_projects USING (project_id)
        LEFT JOIN review_totals USING (project_id)""",
    "mart_estimation_dashboard": f"""
        SELECT project_id, {_PROJECT}, j.created_at AS project_created_at,
            ifnull(page_count, 0) AS page_count, ifnull(discipline_count, 0) AS discipline_count,
            ifnull(takeoffs, 0) AS takeoff_count, ifnull(ai, 0) AS ai_takeoff_count,
            ifnull(manual, 0) AS manual_takeoff_count,
            {_share("ai", "takeoffs", 1)} AS pct_ai_extracted,
            round(ifnull(mean, 0), 3) AS avg_confidence,
            ifnull(low, 0) AS low_confidence_count,
            {_share("low", "takeoffs", 1)} AS pct_low_confidence,
            estimate_id AS latest_estimate_id, ifnull(n.estimate_version, 0) AS estimate_version,
            ifnull(n.estimate_total_low, 0) AS estimate_total_low,
            ifnull(n.estimate_total_mid, 0) AS estimate_total_mid,
            ifnull(n.estimate_total_high, 0) AS estimate_total_high,
            estimation_method, generated_at AS estimate_generated_at,
            ifnull(n.estimate_total_high - n.estimate_total_low, 0) AS estimate_range,
            if(n.estimate_total_mid > 0,
                {_share("(n.estimate_total_high - n.estimate_total_low)", "n.estimate_total_mid", 1)},
                0) AS estimate_range_pct,
            ifnull(total_issues, 0) AS total_qa_issues, ifnull(open_issues, 0) AS open_qa_issues,
            ifnull(critical_issues, 0) AS critical_qa_issues,
            CASE WHEN ifnull(n.estimate_total_mid, 0) = 0 THEN 'No Estimate'
                WHEN open_issues > 0 OR low > 5 THEN 'Needs Review'
                WHEN mean >= 0.8 THEN 'Ready'
                ELSE 'In Progress' END AS readiness_status,
            CASE
                WHEN ifnull(mean, 0) >= CAST(0.85 AS DOUBLE) THEN 'High'
                WHEN ifnull(mean, 0) >= CAST(0.7 AS DOUBLE) THEN 'Medium'
                ELSE 'Low' END
                AS confidence_level,
            round(if(page_count > 0, 25, 0) + if(takeoffs > 0, 25, 0)
                + if(n.estimate_total_mid > 0, 25, 0)
                + if(mean >= 0.7, 25,
                    ifnull(mean, 0) / CAST(0.7 AS DOUBLE) * 25), 0)
                AS completeness_score
        FROM stg_projects j
        LEFT JOIN page_totals USING (project_id)
        LEFT JOIN takeoff_totals USING (project_id)
        LEFT JOIN newest_estimate n USING (project_id)
        LEFT JOIN review_totals USING (project_id)""",
    "delivery_1": _tracked("raw_cost_library"),
    "delivery_3": _tracked("changed_library"),
    "delivery_2": f"SELECT * FROM delivery_3 WHERE division <> 'Brand#11'",
    "history_1": f"SELECT *, {_opening(RUN_TIMES[0])} FROM delivery_1",
    "history_2": _merge("history_1", "delivery_2", RUN_TIMES[1]),
    "history_3": _merge("history_2", "delivery_3", RUN_TIMES[2]),
    "price_history": _merge("history_3", "delivery_3", RUN_TIMES[3]),
}
