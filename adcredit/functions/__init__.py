"""Column-level helpers (all built-in Spark expressions, no UDFs)."""

from adcredit.functions.scalar import (MONEY, fixed_decimals, iso_date, iso_timestamp, latest_struct, money_sum, ratio_or_zero,
                                       round_doubles, safe_divide, to_naive)
from adcredit.functions.predicates import all_of, date_range, equal_filters, optional_eq

__all__ = ["MONEY", "money_sum", "fixed_decimals", "iso_date", "iso_timestamp", "latest_struct", "ratio_or_zero", "round_doubles",
           "safe_divide", "to_naive", "all_of", "date_range", "equal_filters", "optional_eq"]
