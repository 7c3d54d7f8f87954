from plumbline.functions.labels import conditional_count, label, tier_below, tier_from
from plumbline.functions.numeric import avg_decimal, nullif_zero, percent, round_half_away, to_decimal

__all__ = [
    "avg_decimal",
    "conditional_count",
    "label",
    "nullif_zero",
    "percent",
    "round_half_away",
    "tier_below",
    "tier_from",
    "to_decimal",
]
