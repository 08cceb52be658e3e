"""Numbers as printed in statistics tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymart.constants import CSV_NULL_TOKENS, GRID_NULL_TOKENS
from tallymart.functions.text import strip

# A bare try_cast would also accept forms such as 1d, 1f, NaN or Infinity.
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _to_double(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def parse_number(col: Column, null_tokens: Iterable[str] = CSV_NULL_TOKENS) -> Column:
    """``1,234.5`` -> 1234.5; null tokens are tested before commas go."""
    text = strip(col)
    return F.when(~text.isin(*null_tokens), _to_double(F.replace(text, F.lit(","), F.lit(""))))


def parse_grid_number(col: Column, null_tokens: Iterable[str] | Column = GRID_NULL_TOKENS) -> Column:
    """As ``parse_number``, but null tokens (a fixed list, or an array column) are tested after commas go."""
    text = F.replace(strip(col), F.lit(","), F.lit(""))
    is_null = F.array_contains(null_tokens, text) if isinstance(null_tokens, Column) else text.isin(*null_tokens)
    return F.when(~is_null, _to_double(text))


def is_value_token(col: Column) -> Column:
    """A cell that can stand in a data row: a number or a null token."""
    return parse_number(col).isNotNull() | strip(col).isin(*CSV_NULL_TOKENS)


def round_to_int(col: Column) -> Column:
    """Nearest integer, halves to even (a plain cast truncates)."""
    return F.rint(col).cast("int")
