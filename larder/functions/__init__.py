from larder.functions.measures import (
    exact_mean, exact_sum, percent_of, round_for_display, total_of_totals,
)
from larder.functions.text import na_to_null, strip, surrogate_key, to_double, to_int

__all__ = [
    "exact_mean", "exact_sum", "na_to_null", "percent_of", "round_for_display", "strip",
    "surrogate_key", "to_double", "to_int", "total_of_totals",
]
