"""The seven raw tables over the test tables (FIXTURES.md, section 2)."""

_MID = "p_retailprice / (1 + p_size % 20)"
_ITEM = f"""
    'P' || p_partkey AS cost_code, p_brand AS division, p_type AS division_name,
    p_name AS item_type, CASE p_size % 3 WHEN 0 THEN 'EA' WHEN 1 THEN 'SF' WHEN 2 THEN 'LF' ELSE NULL END AS uom"""

TABLES = {
    "raw_projects": f"""
        SELECT c_custkey AS project_id, c_name AS client_name, c_name AS project_name,
            CASE c_mktsegment
                WHEN 'BUILDING' THEN 'residential'
                WHEN 'AUTOMOBILE' THEN 'commercial'
                WHEN 'MACHINERY' THEN 'industrial'
                WHEN 'HOUSEHOLD' THEN 'mixed_use'
                ELSE 'other' END AS project_type,
            lower(n_name) AS location_state,
            DATE '2024-01-01' + CAST(c_custkey % 300 AS INTEGER) AS bid_date,
            'v' || (1 + c_custkey % 5) || '.0' AS plan_set_version,
            CASE c_custkey % 4
                WHEN 0 THEN 'pending'
                WHEN 1 THEN 'in_progress'
                WHEN 2 THEN 'completed'
                WHEN 3 THEN 'on_hold'
                ELSE NULL END AS status,
            CAST(DATE '2024-01-01' + CAST(c_custkey % 300 - 7 AS INTEGER) AS TIMESTAMP)
                AS created_at
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "lettered_orders": """
        SELECT *, CASE WHEN o_orderkey % 97 = 0
            THEN lower(substr('ASCMEP', CAST(1 + o_orderkey % 6 AS INTEGER), 1))
            ELSE substr('ASCMEP', CAST(1 + o_orderkey % 6 AS INTEGER), 1) END AS letter
        FROM orders""",
    "raw_blueprint_pages": """
        SELECT o_orderkey AS page_id, o_custkey AS project_id,
            letter || lpad(CAST(o_orderkey % 15 + 1 AS VARCHAR), 2, '0') AS sheet_number,
            letter AS discipline,
            letter || ' sheet ' || (o_orderkey % 15 + 1) AS page_title,
            '/plans/' || o_custkey || '/' || letter
                || lpad(CAST(o_orderkey % 15 + 1 AS VARCHAR), 2, '0') || '.pdf' AS image_path,
            1 + o_orderkey % 3 AS page_version, o_orderdate AS created_at
        FROM lettered_orders""",
    "raw_cost_library": f"""
        SELECT {_ITEM}, {_MID} * CAST(0.75 AS DOUBLE) AS unit_cost_low,
            {_MID} AS unit_cost_mid, {_MID} * CAST(1.35 AS DOUBLE) AS unit_cost_high,
            DATE '2024-01-01' + CAST(p_partkey % 90 AS INTEGER) AS last_updated
        FROM part""",
    "raw_takeoff_items": f"""
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS takeoff_id,
            o_custkey AS project_id, l_orderkey AS page_id, 'P' || l_partkey AS cost_code,
            p_name AS item_type, l_quantity AS quantity,
            CASE p_size % 3 WHEN 0 THEN 'EA' WHEN 1 THEN 'SF' WHEN 2 THEN 'LF' ELSE NULL END AS uom,
            1 - l_discount * 5 AS confidence,
            CASE l_returnflag
                WHEN 'A' THEN 'ai'
                WHEN 'N' THEN 'manual'
                WHEN 'R' THEN 'hybrid'
                ELSE NULL END AS extraction_method,
            l_shipdate AS created_at
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
            LEFT JOIN part ON l_partkey = p_partkey""",
    "priced_orders": f"""
        SELECT *, CASE WHEN o_orderkey % 50 = 0 THEN CAST(0 AS DOUBLE)
            ELSE o_totalprice * (1 + o_orderkey % 8) END AS mid
        FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "raw_estimates": f"""
        SELECT o_orderkey AS estimate_id, o_custkey AS project_id,
            row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
                AS estimate_version,
            mid * CAST(0.7125 AS DOUBLE) AS estimate_total_low, mid AS estimate_total_mid,
            mid * CAST(1.4175 AS DOUBLE) AS estimate_total_high, o_orderdate AS generated_at,
            CASE o_orderstatus
                WHEN 'F' THEN 'ai'
                WHEN 'O' THEN 'manual'
                WHEN 'P' THEN 'hybrid'
                ELSE NULL END AS estimation_method
        FROM priced_orders""",
    "raw_estimate_line_items": f"""
        SELECT l_orderkey || '-' || l_partkey AS line_item_id, l_orderkey AS estimate_id,
            {_ITEM.replace("p_brand AS division, p_type AS division_name,", "")},
            total AS quantity, {_MID} AS unit_cost_mid, total * ({_MID}) AS extended_cost_mid
        FROM (
            SELECT l_orderkey, l_partkey, sum(l_quantity) AS total
            FROM lineitem SEMI JOIN priced_orders ON l_orderkey = o_orderkey
            GROUP BY ALL
        ) JOIN part ON l_partkey = p_partkey""",
    "raw_qa_reviews": f"""
        SELECT event_id AS review_id, user_id AS project_id,
            CASE WHEN event_id % 3 <> 0 THEN event_id END AS page_id,
            CAST(NULL AS BIGINT) AS takeoff_id,
            CASE event_type
                WHEN 'view' THEN 'missing_item'
                WHEN 'click' THEN 'quantity_mismatch'
                WHEN 'purchase' THEN 'cost_outlier'
                WHEN 'signup' THEN 'duplicate'
                WHEN 'error' THEN 'low_confidence'
                ELSE NULL END AS issue_type,
            CASE WHEN value < 20 THEN 'low' WHEN value < 50 THEN 'medium'
                WHEN value < 120 THEN 'high' ELSE 'critical' END AS severity,
            event_id % 4 <> 0 AS resolved, ts AS reviewed_at
        FROM events""",
    # Deliveries of the cost library for its price history.
    "changed_library": f"""
        SELECT * REPLACE (
            CASE WHEN division = 'Brand#7'
                THEN unit_cost_low * CAST(1.1 AS DOUBLE) ELSE unit_cost_low END AS unit_cost_low,
            CASE WHEN division = 'Brand#7'
                THEN unit_cost_mid * CAST(1.1 AS DOUBLE) ELSE unit_cost_mid END AS unit_cost_mid,
            CASE WHEN division = 'Brand#7'
                THEN unit_cost_high * CAST(1.1 AS DOUBLE) ELSE unit_cost_high END AS unit_cost_high,
            CASE WHEN division = 'Brand#13' THEN 'LOT' ELSE uom END AS uom)
        FROM raw_cost_library
        UNION ALL
        SELECT * REPLACE (cost_code || 'N' AS cost_code)
        FROM raw_cost_library WHERE division = 'Brand#13'""",
}

# The tables with offences: each reads the one above, renamed.
DISPUTED = {
    "raw_cost_library": f"""
        SELECT * FROM changed_library WHERE division <> 'Brand#11'""",
    "raw_takeoff_items": """
        SELECT * REPLACE (
            if(extraction_method = 'hybrid', -quantity, quantity) AS quantity,
            if(extraction_method = 'manual', confidence + CAST(0.25 AS DOUBLE), confidence)
                AS confidence)
        FROM undisputed_raw_takeoff_items""",
    "raw_estimate_line_items": """
        SELECT * REPLACE (
            if(uom = 'LF', 40, 1) * quantity AS quantity,
            if(uom = 'LF', 40, 1) * extended_cost_mid AS extended_cost_mid)
        FROM undisputed_raw_estimate_line_items""",
    "raw_qa_reviews": """
        SELECT * REPLACE (if(severity = 'critical', 'wrong_uom', issue_type) AS issue_type)
        FROM undisputed_raw_qa_reviews""",
}
