"""Column-level helpers (all built-in Spark expressions, no Python UDFs)."""

from memberlens.functions.columns import (day_string, money_sum, days_before, at_midnight,
                                          typed_literal)

__all__ = ["day_string", "money_sum", "days_before", "at_midnight", "typed_literal"]
