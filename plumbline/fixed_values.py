"""Codes, labels, thresholds and declared data tests.

Nothing here is derived. The SQL checks state labels, tiers and thresholds
themselves, so a wrong one here shows; they share the list of declared tests.
"""

# --- value domains ---------------------------------------------------------

PROJECT_TYPES = ["residential", "commercial", "industrial", "mixed_use"]
PROJECT_STATUSES = ["pending", "in_progress", "completed", "on_hold"]
DISCIPLINES = ["A", "S", "C", "M", "E", "P"]
METHODS = ["ai", "manual", "hybrid"]
ISSUE_TYPES = [
    "missing_item",
    "quantity_mismatch",
    "wrong_uom",
    "duplicate",
    "low_confidence",
    "cost_outlier",
]
SEVERITIES = ["low", "medium", "high", "critical"]
READINESS_STATUSES = ["No Estimate", "Needs Review", "In Progress", "Ready"]

# --- labels (value -> label) and the label of everything else --------------

PROJECT_TYPE_LABELS = {
    "residential": "Residential",
    "commercial": "Commercial",
    "industrial": "Industrial",
    "mixed_use": "Mixed Use",
}
PROJECT_TYPE_OTHER = "Other"

DISCIPLINE_LABELS = {
    "A": "Architectural",
    "S": "Structural",
    "C": "Civil",
    "M": "Mechanical",
    "E": "Electrical",
    "P": "Plumbing",
}
DISCIPLINE_OTHER = "Unknown"

EXTRACTION_METHOD_LABELS = {
    "ai": "AI Extracted",
    "manual": "Manual Entry",
    "hybrid": "AI + Manual Review",
}
ESTIMATION_METHOD_LABELS = {
    "ai": "AI Generated",
    "manual": "Manual Estimate",
    "hybrid": "AI + Manual Review",
}
METHOD_OTHER = "Unknown"

ACTIVITY_LABELS = {"ai": "AI", "hybrid": "Hybrid"}
ACTIVITY_OTHER = "Manual"

ISSUE_LABELS = {
    "missing_item": "Missing Item",
    "quantity_mismatch": "Quantity Mismatch",
    "wrong_uom": "Wrong Unit of Measure",
    "duplicate": "Duplicate Entry",
    "low_confidence": "Low Confidence Score",
    "cost_outlier": "Cost Outlier",
}
ISSUE_OTHER = "Other"

SEVERITY_SCORES = {"low": 1, "medium": 2, "high": 3, "critical": 4}
SEVERITY_OTHER = 0
CRITICAL_SEVERITIES = ["high", "critical"]

# --- tiers: bounds in the order they are tried, then the tier of the rest ---
# "below" tiers hold when value < bound, "from" tiers when value >= bound.

COST_TIERS_BELOW = [(50.0, "Low Cost"), (200.0, "Medium Cost")]
COST_TIER_REST = "High Cost"

CONFIDENCE_TIERS_FROM = [(0.90, "High"), (0.75, "Medium"), (0.60, "Low")]
CONFIDENCE_TIER_REST = "Very Low"

ESTIMATE_SIZES_BELOW = [(100000.0, "Small"), (500000.0, "Medium"), (2000000.0, "Large")]
ESTIMATE_SIZE_REST = "Enterprise"

COST_IMPACTS_BELOW = [(1000.0, "Minor"), (10000.0, "Moderate"), (50000.0, "Significant")]
COST_IMPACT_REST = "Major"

CONFIDENCE_LEVELS_FROM = [(0.85, "High"), (0.70, "Medium")]
CONFIDENCE_LEVEL_REST = "Low"

CONFIDENCE_BANDS_FROM = [(0.85, "high"), (0.75, "med")]
CONFIDENCE_BAND_REST = "low"

# --- thresholds ------------------------------------------------------------

LOW_CONFIDENCE = 0.60            # below: a low-confidence takeoff
MAX_LOW_CONFIDENCE_PCT = 20.0    # above: a project or warehouse is flagged
READY_CONFIDENCE = 0.80
READY_MAX_LOW_ITEMS = 5
COMPLETE_CONFIDENCE = 0.70
COMPLETENESS_SHARE = 25
EXCELLENT_CONFIDENCE = 0.85
GOOD_CONFIDENCE = 0.75
ACCEPTABLE_CONFIDENCE = 0.65
ATTENTION_OPEN_ISSUES = 5        # quality monitoring: more open issues than this
DASHBOARD_OPEN_ISSUES = 2        # dashboard list: more open issues than this
LOW_TOTAL_FACTOR = 0.95          # estimate roll-up
HIGH_TOTAL_FACTOR = 1.05

# --- declared data tests ---------------------------------------------------

TEST_SEVERITY = "warn"

UNIQUE = {
    "raw.projects": ["project_id"],
    "raw.blueprint_pages": ["page_id"],
    "raw.cost_library": ["cost_code"],
    "raw.takeoff_items": ["takeoff_id"],
    "raw.estimates": ["estimate_id"],
    "raw.estimate_line_items": ["line_item_id"],
    "raw.qa_reviews": ["review_id"],
    "stg_projects": ["project_id"],
    "stg_blueprint_pages": ["page_id"],
    "stg_cost_library": ["cost_code"],
    "stg_takeoff_items": ["takeoff_id"],
    "stg_estimates": ["estimate_id"],
    "stg_estimate_line_items": ["line_item_id"],
    "stg_qa_reviews": ["review_id"],
    "fct_takeoffs": ["takeoff_id"],
    "fct_estimates": ["estimate_id"],
    "mart_estimation_dashboard": ["project_id"],
}

NOT_NULL = {
    "raw.projects": ["project_id"],
    "raw.blueprint_pages": ["page_id", "project_id"],
    "raw.cost_library": ["cost_code"],
    "raw.takeoff_items": ["takeoff_id", "project_id", "page_id", "cost_code"],
    "raw.estimates": ["estimate_id", "project_id"],
    "raw.estimate_line_items": ["line_item_id", "estimate_id", "cost_code"],
    "raw.qa_reviews": ["review_id", "project_id"],
    "stg_projects": ["project_id"],
    "stg_blueprint_pages": ["page_id", "project_id"],
    "stg_cost_library": ["cost_code", "unit_cost_mid"],
    "stg_takeoff_items": ["takeoff_id", "project_id", "page_id", "cost_code", "confidence"],
    "stg_estimates": ["estimate_id", "project_id", "estimate_total_mid"],
    "stg_estimate_line_items": ["line_item_id", "estimate_id", "cost_code"],
    "stg_qa_reviews": ["review_id", "project_id"],
    "fct_takeoffs": [
        "takeoff_id", "project_id", "page_id", "cost_code", "quantity", "confidence",
    ],
    "fct_estimates": ["estimate_id", "project_id", "estimate_total_mid"],
    "mart_estimate_cost_breakdown": ["estimate_id", "cost_code", "extended_cost_mid"],
    "mart_takeoff_quality_monitoring": ["project_id"],
    "mart_estimation_dashboard": ["project_id"],
}

ACCEPTED_VALUES = {
    "raw.projects": {"project_type": PROJECT_TYPES, "status": PROJECT_STATUSES},
    "raw.blueprint_pages": {"discipline": DISCIPLINES},
    "raw.takeoff_items": {"extraction_method": METHODS},
    "raw.estimates": {"estimation_method": METHODS},
    "raw.qa_reviews": {"issue_type": ISSUE_TYPES, "severity": SEVERITIES},
    "stg_blueprint_pages": {"discipline": DISCIPLINES},
    "stg_takeoff_items": {"extraction_method": METHODS},
    "stg_estimates": {"estimation_method": METHODS},
    "stg_qa_reviews": {"issue_type": ISSUE_TYPES, "severity": SEVERITIES},
    "fct_takeoffs": {"extraction_method": METHODS},
    "fct_estimates": {"estimation_method": METHODS},
    "mart_takeoff_quality_monitoring": {"discipline": DISCIPLINES},
    "mart_estimation_dashboard": {"readiness_status": READINESS_STATUSES},
}

# (child table, child column, parent table, parent column)
RELATIONSHIPS = [
    ("raw.blueprint_pages", "project_id", "raw.projects", "project_id"),
    ("raw.takeoff_items", "project_id", "raw.projects", "project_id"),
    ("raw.takeoff_items", "page_id", "raw.blueprint_pages", "page_id"),
    ("raw.takeoff_items", "cost_code", "raw.cost_library", "cost_code"),
    ("raw.estimates", "project_id", "raw.projects", "project_id"),
    ("raw.estimate_line_items", "estimate_id", "raw.estimates", "estimate_id"),
    ("raw.estimate_line_items", "cost_code", "raw.cost_library", "cost_code"),
    ("raw.qa_reviews", "project_id", "raw.projects", "project_id"),
]
