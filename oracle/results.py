"""One statement per registered query, in the compared types."""

from __future__ import annotations

from oracle.marts import _share
from oracle.text import members
from plumbline import fixed_values as fixed
from plumbline.schemas import RAW_TABLES, raw_columns

_MONEY = {
    "stg_cost_library": ["unit_cost_low", "unit_cost_mid", "unit_cost_high"],
    "stg_takeoff_items": ["quantity", "confidence"],
    "stg_estimates": ["estimate_total_low", "estimate_total_mid", "estimate_total_high"],
    "stg_estimate_line_items": ["quantity", "unit_cost_mid", "extended_cost_mid"],
    "fct_takeoffs": [
        "quantity", "confidence", "unit_cost_low", "unit_cost_mid", "unit_cost_high",
        "extended_cost_low", "extended_cost_mid", "extended_cost_high", "line_total",
    ],
    "fct_estimates": [
        "estimate_total_low", "estimate_total_mid", "estimate_total_high", "calculated_total",
    ],
    "mart_estimate_cost_breakdown": [
        "quantity", "unit_cost_mid", "extended_cost_mid", "extended_cost_low",
        "extended_cost_high", "estimate_total_mid",
    ],
    "mart_takeoff_quality_monitoring": ["total_quantity", "min_confidence", "max_confidence"],
    "mart_estimation_dashboard": [
        "estimate_total_low", "estimate_total_mid", "estimate_total_high", "estimate_range",
    ],
    "newest_estimate": ["estimate_total_low", "estimate_total_mid", "estimate_total_high"],
}
_DATES = {
    "stg_projects": ["bid_date"],
    "stg_cost_library": ["last_updated"],
    "fct_takeoffs": ["bid_date"],
    "fct_estimates": ["bid_date"],
    "mart_estimation_dashboard": ["bid_date"],
    "raw_projects": ["bid_date"],
    "raw_cost_library": ["last_updated"],
    "history_1": ["last_updated"],
    "price_history": ["last_updated"],
}
_WHOLE = {
    "stg_qa_reviews": ["severity_score"],
}


def _whole_table(table: str) -> str:
    """All rows and columns; decimals as doubles, dates as timestamps."""
    casts = (
        [f"CAST({name} AS DOUBLE) AS {name}" for name in _MONEY.get(table, [])]
        + [f"CAST({name} AS TIMESTAMP) AS {name}" for name in _DATES.get(table, [])]
        + [f"CAST({name} AS BIGINT) AS {name}" for name in _WHOLE.get(table, [])]
    )
    replaced = f" REPLACE ({', '.join(casts)})" if casts else ""
    return f"SELECT *{replaced} FROM {table}"


# --- data tests -------------------------------------------------------------------


def _sql_name(table: str) -> str:
    return table.replace("raw.", "raw_")


def _verdict(test: str, table: str, column: str, failures: str) -> str:
    return f"""
        SELECT '{test}' AS test, '{table}' AS table_name, '{column}' AS column_name,
            'warn' AS severity, CAST(n AS BIGINT) AS failures, n = 0 AS passed
        FROM ({failures})"""


def _unique(table: str, column: str) -> str:
    return _verdict(
        "unique", table, column,
        f"""SELECT count(*) AS n FROM (
            SELECT {column} FROM {_sql_name(table)} WHERE {column} IS NOT NULL
            GROUP BY {column} HAVING count(*) > 1)""",
    )


def _not_null(table: str, column: str) -> str:
    return _verdict(
        "not_null", table, column,
        f"SELECT count(*) AS n FROM {_sql_name(table)} WHERE {column} IS NULL",
    )


def _accepted(table: str, column: str, values: list[str]) -> str:
    return _verdict(
        "accepted_values", table, column,
        f"""SELECT count(DISTINCT {column}) AS n FROM {_sql_name(table)}
            WHERE {column} NOT IN {members(values)}""",
    )


def _related(child: str, column: str, parent: str, parent_column: str) -> str:
    return _verdict(
        "relationships", child, column,
        f"""SELECT count(*) AS n FROM {_sql_name(child)} c
            ANTI JOIN {_sql_name(parent)} p ON c.{column} = p.{parent_column}
            WHERE c.{column} IS NOT NULL""",
    )


_UNIQUE = [_unique(t, c) for t, columns in fixed.UNIQUE.items() for c in columns]
_NOT_NULL = [_not_null(t, c) for t, columns in fixed.NOT_NULL.items() for c in columns]
_ACCEPTED = [
    _accepted(t, c, values)
    for t, columns in fixed.ACCEPTED_VALUES.items()
    for c, values in columns.items()
]
_RELATED = [_related(*entry) for entry in fixed.RELATIONSHIPS]
_ROW_TESTS = [
    _verdict(
        "positive_quantities", "stg_takeoff_items", "quantity",
        "SELECT count(*) AS n FROM stg_takeoff_items WHERE quantity <= 0",
    ),
    _verdict(
        "valid_confidence", "stg_takeoff_items", "confidence",
        "SELECT count(*) AS n FROM stg_takeoff_items WHERE confidence < 0 OR confidence > 1",
    ),
]


def _all(statements: list[str]) -> str:
    return " UNION ALL ".join(statements)


def _orphans(child: str, column: str, parent: str, parent_column: str) -> str:
    child, parent = child.replace("raw.", "stg_"), parent.replace("raw.", "stg_")
    return f"""
        SELECT '{child}' AS child_table, '{column}' AS column_name, '{parent}' AS parent_table,
            CAST(c.{column} AS VARCHAR) AS missing_key, count(*) AS rows
        FROM {child} c ANTI JOIN {parent} p ON c.{column} = p.{parent_column}
        WHERE c.{column} IS NOT NULL GROUP BY c.{column}"""


# --- checks and report --------------------------------------------------------------

_LOW = f"confidence < 0.6"
_HIGH_SHARE = f"pct_low_confidence > 20.0"

_CHECKS = f"""
    SELECT * FROM (
        SELECT
            count(*) FILTER (quantity <= 0) AS invalid_quantities,
            count(*) FILTER (confidence < 0 OR confidence > 1) AS invalid_confidence,
            count(*) AS total_takeoffs, round(avg(confidence), 3) AS avg_confidence,
            count(*) FILTER ({_LOW}) AS low_confidence_count,
            CAST(sum(extended_cost_mid) AS DOUBLE) AS total_extended_cost
        FROM fct_takeoffs
    ) POSITIONAL JOIN (
        SELECT count(*) AS crowded FROM mart_estimation_dashboard WHERE {_HIGH_SHARE}
    ) POSITIONAL JOIN (
        SELECT string_agg(project_name, ', ' ORDER BY project_id) AS names FROM (
            SELECT project_id, project_name FROM mart_estimation_dashboard WHERE {_HIGH_SHARE}
            ORDER BY project_id LIMIT 3)
    ) POSITIONAL JOIN (
        SELECT count(*) FILTER (ifnull(estimate_total_mid, 0) = 0) AS zero_estimates,
            count(*) AS total_estimates,
            CAST(sum(estimate_total_mid) AS DOUBLE) AS total_estimate_value,
            round(avg(estimate_total_mid), 2) AS avg_estimate
        FROM fct_estimates
    )"""

_CHECK_ROWS = f"""
    SELECT v.check, CAST(v.value AS DOUBLE) AS value, v.passed, v.issue
    FROM ({_CHECKS}) c, LATERAL (VALUES
        ('invalid_quantities', c.invalid_quantities, c.invalid_quantities = 0,
            if(c.invalid_quantities > 0,
                c.invalid_quantities || ' takeoffs with a non-positive quantity', NULL)),
        ('invalid_confidence', c.invalid_confidence, c.invalid_confidence = 0,
            if(c.invalid_confidence > 0,
                c.invalid_confidence || ' takeoffs with a confidence outside 0 to 1', NULL)),
        ('projects_with_high_low_confidence', c.crowded, c.crowded = 0,
            if(c.crowded > 0, c.crowded
                || ' projects with too many low-confidence takeoffs, first: ' || c.names, NULL)),
        ('zero_estimates', c.zero_estimates, c.zero_estimates = 0,
            if(c.zero_estimates > 0,
                c.zero_estimates || ' estimates with a zero or missing total', NULL)),
        ('total_takeoffs', c.total_takeoffs, NULL, NULL),
        ('avg_confidence', c.avg_confidence, NULL, NULL),
        ('low_confidence_count', c.low_confidence_count, NULL, NULL),
        ('total_extended_cost', c.total_extended_cost, NULL, NULL),
        ('total_estimates', c.total_estimates, NULL, NULL),
        ('total_estimate_value', c.total_estimate_value, NULL, NULL),
        ('avg_estimate', c.avg_estimate, NULL, NULL),
        ('all', (c.invalid_quantities > 0)::INT + (c.invalid_confidence > 0)::INT
            + (c.crowded > 0)::INT + (c.zero_estimates > 0)::INT,
            c.invalid_quantities + c.invalid_confidence + c.crowded + c.zero_estimates = 0, NULL)
    ) v("check", value, passed, issue)"""

_COUNTS = """
    SELECT (SELECT count(*) FROM stg_projects) AS project_count,
        (SELECT count(*) FROM stg_blueprint_pages) AS page_count"""

_PAGES = """
    SELECT discipline, discipline_name, count(*) AS page_count
    FROM stg_blueprint_pages GROUP BY ALL"""

_TAKEOFFS = f"""
    SELECT count(*) AS total_takeoffs,
        count(*) FILTER (extraction_method = 'ai') AS ai_takeoffs,
        count(*) FILTER (extraction_method = 'manual') AS manual_takeoffs,
        count(*) FILTER (extraction_method = 'hybrid') AS hybrid_takeoffs,
        round(avg(confidence), 3) AS avg_confidence,
        count(*) FILTER ({_LOW}) AS low_confidence_count,
        {_share("count(*) FILTER (extraction_method = 'ai')", "count(*)", 1)} AS pct_ai,
        {_share(f"count(*) FILTER ({_LOW})", "count(*)", 1)} AS pct_low_confidence
    FROM fct_takeoffs"""

_ESTIMATES = """
    SELECT count(*) AS total_estimates, CAST(sum(estimate_total_mid) AS DOUBLE) AS sum_mid,
        round(avg(estimate_total_mid), 2) AS avg_mid,
        round(quantile_cont(CAST(estimate_total_mid AS DOUBLE), 0.5), 4) AS p50_mid,
        round(quantile_cont(CAST(estimate_total_mid AS DOUBLE), 0.9), 4) AS p90_mid
    FROM fct_estimates"""

_TOP_CODES = """
    SELECT cost_code, division_name, item_type,
        CAST(sum(extended_cost_mid) AS DOUBLE) AS total_extended_cost,
        count(*) AS takeoff_count,
        row_number() OVER (ORDER BY sum(extended_cost_mid) DESC, cost_code, item_type) AS rank
    FROM fct_takeoffs GROUP BY cost_code, division_name, item_type
    QUALIFY rank <= 10"""

_QA = """
    SELECT count(*) AS total_issues, count(*) FILTER (NOT resolved) AS open_issues,
        count(*) FILTER (is_critical) AS critical_issues,
        round(count(*) / (SELECT count(*) FROM stg_projects), 2) AS issues_per_project
    FROM stg_qa_reviews"""

_READINESS = """
    SELECT readiness_status, count(*) AS project_count
    FROM mart_estimation_dashboard GROUP BY readiness_status"""


def _unfold(section: str, statement: str) -> str:
    return f"""
        SELECT '{section}' AS section, name AS metric, value FROM (
            UNPIVOT (SELECT CAST(COLUMNS(*) AS DOUBLE) FROM ({statement}))
            ON COLUMNS(*) INTO NAME name VALUE value)"""


_SUMMARY = [
    _unfold("summary", _COUNTS),
    _unfold("takeoffs", _TAKEOFFS),
    _unfold("estimates", _ESTIMATES),
    f"""SELECT 'pages', discipline || ' ' || discipline_name, CAST(page_count AS DOUBLE)
        FROM ({_PAGES})""",
    f"SELECT 'top_cost_codes', cost_code, total_extended_cost FROM ({_TOP_CODES})",
    _unfold("qa", _QA),
    f"SELECT 'readiness', readiness_status, CAST(project_count AS DOUBLE) FROM ({_READINESS})",
    f"""SELECT 'quality', 'all_checks_passed', CAST(passed AS DOUBLE)
        FROM ({_CHECK_ROWS}) WHERE "check" = 'all'""",
]

# --- loads with lines that do not fit -------------------------------------------------

_CODE_NUMBER = "CAST(substr(cost_code, 2) AS BIGINT)"
_BAD_PRICE, _BAD_DATE = f"{_CODE_NUMBER} % 7 = 0", f"{_CODE_NUMBER} % 11 = 0"
_BAD_LINES = {
    "projects": "project_id % 13 = 0",
    "cost_library": f"({_BAD_PRICE} OR {_BAD_DATE})",
    "takeoff_items": "page_id % 17 = 0",
}
_DAMAGED_AUDIT = _all(
    [
        f"""SELECT '{name}' AS table_name, count(*) FILTER (NOT {bad}) AS row_count,
            CAST(1 AS BIGINT) AS tables_loaded, count(*) FILTER ({bad}) AS rejected_rows FROM raw_{name}"""
        for name, bad in _BAD_LINES.items()
    ]
)
_REASONS = [
    ("projects", "wrong number of fields", _BAD_LINES["projects"]),
    ("cost_library", "unit_cost_mid is no double", _BAD_PRICE),
    ("cost_library", "last_updated is no date", _BAD_DATE),
    ("takeoff_items", "quantity is no double", _BAD_LINES["takeoff_items"]),
]

# --- all results -----------------------------------------------------------------------

RESULTS: dict[str, str] = {
    **{f"stg_{name}": _whole_table(f"stg_{name}") for name in RAW_TABLES},
    **{
        name: _whole_table(name)
        for name in (
            "fct_takeoffs", "fct_estimates", "mart_estimate_cost_breakdown",
            "mart_takeoff_quality_monitoring", "mart_estimation_dashboard",
        )
    },
    "agg_distinct_counts": "SELECT * FROM page_totals",
    "agg_estimate_details": """
        SELECT * REPLACE (CAST(calculated_total AS DOUBLE) AS calculated_total)
        FROM line_totals""",
    "agg_confidence_stats": """
        SELECT project_id, mean AS avg_confidence, CAST(least AS DOUBLE) AS min_confidence,
            CAST(most AS DOUBLE) AS max_confidence, low AS low_confidence_count
        FROM takeoff_totals""",
    "agg_method_mix": """
        SELECT project_id, takeoffs AS total_takeoffs, ai AS ai_takeoffs,
            manual AS manual_takeoffs, hybrid AS hybrid_takeoffs
        FROM takeoff_totals""",
    "agg_qa_by_project": "SELECT * FROM review_totals",
    "latest_estimate_per_project": _whole_table("newest_estimate"),
    "estimate_rollup": f"""
        SELECT estimate_id, project_id, estimate_version,
            round(ifnull(low, 0) * factor * CAST(0.95 AS DOUBLE), 2)
                AS estimate_total_low,
            round(ifnull(mid, 0) * factor, 2) AS estimate_total_mid,
            round(ifnull(high, 0) * factor * CAST(1.05 AS DOUBLE), 2)
                AS estimate_total_high
        FROM (
            SELECT *, CAST(1 AS DOUBLE) + CAST(estimate_version - 1 AS DOUBLE)
                * (CAST(estimate_id % 16 - 5 AS DOUBLE) / CAST(100 AS DOUBLE)) AS factor
            FROM raw_estimates
        ) LEFT JOIN (
            SELECT project_id, CAST(sum(quantity * unit_cost_low) AS DOUBLE) AS low,
                CAST(sum(quantity * unit_cost_mid) AS DOUBLE) AS mid,
                CAST(sum(quantity * unit_cost_high) AS DOUBLE) AS high
            FROM stg_takeoff_items JOIN stg_cost_library USING (cost_code)
            GROUP BY project_id
        ) USING (project_id)""",
    "estimate_line_item_rollup": """
        SELECT estimate_id, cost_code, item_type, CAST(total AS DOUBLE) AS quantity, uom,
            CAST(unit_cost_mid AS DOUBLE) AS unit_cost_mid,
            CAST(round(total * unit_cost_mid, 2) AS DOUBLE) AS extended_cost_mid
        FROM stg_estimates JOIN (
            SELECT project_id, cost_code, min(item_type) AS item_type, min(uom) AS uom,
                sum(quantity) AS total
            FROM stg_takeoff_items GROUP BY project_id, cost_code
        ) USING (project_id)
        JOIN (SELECT cost_code, unit_cost_mid FROM stg_cost_library) USING (cost_code)""",
    "derive_business_keys": """
        SELECT 'cost_library' AS source, cost_code AS source_key,
            division || '-' || upper(left(item_type, 4)) AS business_key
        FROM raw_cost_library
        UNION ALL
        SELECT 'blueprint_pages', CAST(page_id AS VARCHAR),
            printf('%s%02d', discipline, page_id % 150 + 1)
        FROM raw_blueprint_pages""",
    "cost_library_snapshot_initial": _whole_table("history_1"),
    "cost_library_snapshot_merge": _whole_table("price_history"),
    "cost_library_as_of": """
        SELECT t.takeoff_id, t.cost_code, CAST(t.quantity AS DOUBLE) AS quantity, t.created_at,
            h.valid_from, h.scd_id, h.unit_cost_low, h.unit_cost_mid, h.unit_cost_high,
            CAST(t.quantity AS DOUBLE) * h.unit_cost_mid AS extended_cost_mid
        FROM stg_takeoff_items t LEFT JOIN price_history h
            ON t.cost_code = h.cost_code AND t.created_at >= h.valid_from
            AND t.created_at < ifnull(h.valid_to, TIMESTAMP '9999-12-31')""",
    "cost_library_price_change": f"""
        SELECT *, {_share("unit_cost_mid - previous_unit_cost_mid", "previous_unit_cost_mid", 2)}
            AS change_pct
        FROM (
            SELECT cost_code, row_number() OVER versions AS version_number, valid_from, valid_to,
                unit_cost_mid, lag(unit_cost_mid) OVER versions AS previous_unit_cost_mid
            FROM price_history WINDOW versions AS (PARTITION BY cost_code ORDER BY valid_from))""",
    "dq_unique": _all(_UNIQUE),
    "dq_not_null": _all(_NOT_NULL),
    "dq_accepted_values": _all(_ACCEPTED),
    "dq_relationships": _all(_RELATED),
    "dq_positive_quantities": """
        SELECT takeoff_id, CAST(quantity AS DOUBLE) AS quantity
        FROM stg_takeoff_items WHERE quantity <= 0""",
    "dq_valid_confidence": """
        SELECT takeoff_id, CAST(confidence AS DOUBLE) AS confidence
        FROM stg_takeoff_items WHERE confidence NOT BETWEEN 0 AND 1""",
    "dq_test_results": _all(_UNIQUE + _NOT_NULL + _ACCEPTED + _RELATED + _ROW_TESTS),
    "dq_orphans": _all([_orphans(*entry) for entry in fixed.RELATIONSHIPS]),
    "dq_checks_summary": _CHECK_ROWS,
    "dq_high_low_confidence_projects": f"""
        SELECT project_id, project_name, pct_low_confidence
        FROM mart_estimation_dashboard WHERE {_HIGH_SHARE}""",
    "dq_first_low_confidence_projects": f"""
        SELECT project_id, project_name, pct_low_confidence
        FROM mart_estimation_dashboard WHERE {_HIGH_SHARE} ORDER BY project_id LIMIT 3""",
    "check_valid_quantities": f"""
        SELECT *, ifnull({_share("total_takeoffs - invalid_quantities", "total_takeoffs", 2)}, 0)
                AS pct_valid,
            ifnull(invalid_quantities = 0, false) AS passed,
            if(ifnull(invalid_quantities = 0, false), 'WARN', 'ERROR') AS severity
        FROM (
            SELECT count(*) AS total_takeoffs,
                CAST(sum(CAST(quantity <= 0 AS INTEGER)) AS BIGINT) AS invalid_quantities
            FROM fct_takeoffs)""",
    "check_confidence_distribution": f"""
        SELECT total_takeoffs, ifnull(round(mean, 3), 0) AS avg_confidence, low_confidence_count,
            ifnull({_share("low_confidence_count", "total_takeoffs", 2)}, 0) AS pct_low_confidence,
            CAST(0.6 AS DOUBLE) AS threshold,
            ifnull(CAST(low_confidence_count AS DOUBLE) / nullif(total_takeoffs, 0) * 100, 0)
                <= 20.0 AS passed,
            'WARN' AS severity
        FROM (
            SELECT count(*) AS total_takeoffs, avg(confidence) AS mean,
                CAST(sum(CAST({_LOW} AS INTEGER)) AS BIGINT) AS low_confidence_count
            FROM fct_takeoffs)""",
    "rpt_counts": _COUNTS,
    "rpt_pages_by_discipline": _PAGES,
    "rpt_takeoff_stats": _TAKEOFFS,
    "rpt_estimate_stats": _ESTIMATES,
    "rpt_top_cost_codes": _TOP_CODES,
    "rpt_qa_stats": _QA,
    "rpt_readiness": _READINESS,
    "rpt_summary": _all(_SUMMARY),
    "adhoc_top_cost_codes": """
        SELECT cost_code, division_name, CAST(sum(extended_cost_mid) AS DOUBLE) AS total_cost
        FROM fct_takeoffs GROUP BY ALL
        ORDER BY sum(extended_cost_mid) DESC, cost_code, division_name LIMIT 5""",
    "adhoc_readiness_summary": """
        SELECT readiness_status, count(*) AS projects,
            round(avg(CAST(avg_confidence AS DECIMAL(5, 3))), 3) AS avg_confidence
        FROM mart_estimation_dashboard GROUP BY readiness_status""",
    "dash_portfolio": """
        SELECT count(*) AS total_projects,
            round(CAST(sum(estimate_total_mid) AS DOUBLE) / 1000000, 1)
                AS portfolio_value_millions,
            round(avg(CAST(avg_confidence AS DECIMAL(5, 3))), 3) AS avg_ai_confidence,
            CAST(sum(takeoff_count) AS BIGINT) AS total_takeoffs
        FROM mart_estimation_dashboard WHERE estimate_total_mid > 0""",
    "dash_attention_projects": f"""
        SELECT project_name,
            round(CAST(estimate_total_mid AS DOUBLE) / 1000000, 2) AS estimate_millions,
            round(avg_confidence, 2) AS confidence, open_qa_issues, readiness_status
        FROM mart_estimation_dashboard
        WHERE readiness_status = 'Needs Review' OR open_qa_issues > 2
        ORDER BY estimate_total_mid DESC, project_id LIMIT 5""",
    "dash_cost_drivers": """
        SELECT division_name, item_type, count(*) AS occurrences,
            round(CAST(sum(extended_cost_mid) AS DOUBLE) / 1000000, 2) AS total_cost_millions
        FROM fct_takeoffs GROUP BY division_name, item_type
        ORDER BY sum(extended_cost_mid) DESC, division_name, item_type LIMIT 5""",
    "dash_ai_performance": f"""
        SELECT *, CASE
            WHEN avg_confidence >= CAST(0.85 AS DOUBLE) THEN 'high'
            WHEN avg_confidence >= CAST(0.75 AS DOUBLE) THEN 'med'
            ELSE 'low' END
            AS confidence_band
        FROM (
            SELECT discipline_name, count(*) AS takeoffs,
                round(avg(confidence), 3) AS avg_confidence,
                {_share("count(*) FILTER (is_low_confidence)", "count(*)", 1)} AS pct_needs_review
            FROM fct_takeoffs GROUP BY discipline_name)""",
    "dash_readiness": f'SELECT readiness_status, project_count AS "count" FROM ({_READINESS})',
    "dash_recent_activity": f"""
        SELECT project_name, estimation_method, date_trunc('day', generated_at) AS activity_date,
            CASE estimation_method
                WHEN 'ai' THEN 'AI'
                WHEN 'hybrid' THEN 'Hybrid'
                ELSE 'Manual' END
                AS method_label
        FROM fct_estimates ORDER BY generated_at DESC, estimate_id LIMIT 4""",
    **{f"raw_csv_roundtrip_{name}": _whole_table(f"raw_{name}") for name in RAW_TABLES},
    "raw_csv_roundtrip": _all(
        [
            f"""SELECT '{table}' AS table_name, '{column}' AS column_name,
                count(*) AS row_count, count({column}) AS non_null_values FROM raw_{table}"""
            for table in RAW_TABLES
            for column in raw_columns(table)
        ]
    ),
    "load_audit": _all(
        [
            f"""SELECT '{name}' AS table_name, count(*) AS row_count,
                CAST(1 AS BIGINT) AS tables_loaded FROM raw_{name}"""
            for name in RAW_TABLES
        ]
        + [
            "SELECT 'total', ("
            + " + ".join(f"(SELECT count(*) FROM raw_{name})" for name in RAW_TABLES)
            + f"), {len(RAW_TABLES)}"
        ]
    ),
    "table_inventory": _all(
        [
            f"SELECT 'raw.{name}' AS table_name, true AS table_exists, count(*) AS row_count FROM raw_{name}"
            for name in RAW_TABLES
        ]
        + ["SELECT 'raw.change_orders', false, NULL"]
    ),
    "load_audit_damaged": f"""
        SELECT * FROM ({_DAMAGED_AUDIT}) UNION ALL
        SELECT 'total', CAST(sum(row_count) AS BIGINT), count(*), CAST(sum(rejected_rows) AS BIGINT)
        FROM ({_DAMAGED_AUDIT})""",
    "load_reject_reasons": _all(
        [
            f"SELECT '{name}' AS table_name, '{reason}' AS reason, count(*) AS rows FROM raw_{name} WHERE {bad} HAVING count(*) > 0"
            for name, reason, bad in _REASONS
        ]
    ),
    "damaged_cost_library": _whole_table("raw_cost_library") + f" WHERE NOT {_BAD_LINES['cost_library']}",
}
