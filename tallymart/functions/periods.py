"""Printed periods -> start-of-period dates.

Plain string tests instead of patterns: a text is looked at by the one notation it
can be, and every step runs inside generated code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymart.constants import EXTRA_MONTH_SPELLINGS, MONTH_NAMES, WHITESPACE
from tallymart.functions.text import split_words, strip

_SPELLINGS = [*MONTH_NAMES, *(name[:3] for name in MONTH_NAMES), *EXTRA_MONTH_SPELLINGS]
_MONTH_OF_PREFIX = {name[:3]: number for number, name in enumerate(MONTH_NAMES, start=1)}
_DIGITS = "0123456789"
_QUARTERS = ("Q1", "Q2", "Q3", "Q4")


def _array(values: Sequence[str | int]) -> Column:
    """A constant array, written as one expression to spare a call per element."""
    return F.expr(f"array({', '.join(map(repr, values))})")


def _number(text: Column) -> Column:
    """Value of a text made of digits only, else null."""
    return F.when(F.translate(text, _DIGITS, "") == "", text.try_cast("int"))


def _date(year: Column, month: Column) -> Column:
    """Null unless both are known and the year has one to four digits."""
    return F.when(year.between(1, 9999), F.make_date(year, month, F.lit(1)))


def _bare_year(text: Column) -> Column:
    year = _number(text)
    return F.when(year.between(1900, 2100), F.make_date(year, F.lit(1), F.lit(1)))


def _month(text: Column) -> Column:
    at = F.array_position(_array(_SPELLINGS), F.lower(text)).cast("int")
    return F.get(_array([_MONTH_OF_PREFIX[s[:3]] for s in _SPELLINGS]), at - 1)


def _quarter_month(text: Column) -> Column:
    at = F.array_position(_array(_QUARTERS), text).cast("int")
    return F.when(at > 0, at * 3 - 2)


def parse_period(col: Column) -> Column:
    """``2021``, ``Feb 1990``, ``1990 March``, ``1991/Q1``; anything else is null."""
    text = strip(col)
    head = F.substring_index(text, "/", 1)
    tail = F.substring(text, F.length(head) + 2, F.length(text))
    words = split_words(text)
    first, second = F.get(words, F.lit(0)), F.get(words, F.lit(1))
    return (
        F.when(F.contains(text, F.lit("/")), _date(_number(head), _quarter_month(tail)))
        .when(F.translate(text, _DIGITS, "") == "", _bare_year(text))
        .when(F.size(words) == 2, F.coalesce(_date(_number(first), _month(second)), _date(_number(second), _month(first))))
    )


def parse_grid_period(col: Column) -> Column:
    """``2012Q3``, ``2012/Q3``, ``2012 Q3`` or ``2012``."""
    text = strip(col)
    blanks = F.lit(WHITESPACE)
    rest = F.ltrim(F.substring(text, F.lit(5), F.length(text)), blanks)
    quarter = F.when(rest.startswith("/"), F.ltrim(F.substring(rest, F.lit(2), F.length(rest)), blanks)).otherwise(rest)
    year = F.substring(text, 1, 4)
    return F.when(F.translate(text, _DIGITS, "") == "", _bare_year(text)).otherwise(
        F.when(F.length(year) == 4, _date(_number(year), _quarter_month(quarter)))
    )


def subtitle_period(line: Column) -> Column:
    """Period at the head of a subtitle: the whole line, then its 3, 2 and 1 first words."""
    words = split_words(line)
    heads = F.array(line, *(F.array_join(F.slice(words, 1, n), " ") for n in (3, 2, 1)))
    # Bound one by one, so that a head is put together once and not per test.
    found = F.filter(F.transform(heads, parse_period), lambda p: p.isNotNull())
    return F.get(found, F.lit(0))


def period_year(col: Column) -> Column:
    return F.year(col).cast("smallint")


def period_label(col: Column) -> Column:
    """``Oct 2025``."""
    return F.date_format(col, "MMM yyyy")
