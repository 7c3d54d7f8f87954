"""The registered queries once more, as SQL for an independent engine."""

from oracle.assemble import DISPUTED_TABLES, assemble
from oracle.results import RESULTS

ORACLE_SQL = {name: assemble(text) for name, text in RESULTS.items()}

DISPUTED = [
    "stg_estimate_line_items", "stg_qa_reviews", "fct_takeoffs", "mart_takeoff_quality_monitoring",
    "dq_relationships", "dq_orphans", "dq_positive_quantities", "dq_valid_confidence",
    "dq_test_results", "dq_checks_summary", "check_valid_quantities",
]
ORACLE_SQL |= {f"{name}_disputed": assemble(RESULTS[name], DISPUTED_TABLES) for name in DISPUTED}

# The same results over tables stored in buckets.
COLOCATED = ["fct_takeoffs", "mart_takeoff_quality_monitoring"]
ORACLE_SQL |= {f"{name}_colocated": ORACLE_SQL[name] for name in COLOCATED}
