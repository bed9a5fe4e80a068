"""Column expressions and null handling shared by the operators."""

from daybook.functions.defaults import fill_zero, with_defaults
from daybook.functions.picks import earliest, most_frequent

__all__ = ["earliest", "fill_zero", "most_frequent", "with_defaults"]
