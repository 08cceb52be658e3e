"""Names, paths and delimited lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymart.constants import DASHES, WHITESPACE

# Line ends of an exported file; a lone CR, form feed or NEL ends a line too.
LINE_BREAK = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85]"

# One cell of ",a,b,..": quoted (doubled quotes inside, maybe unterminated) or bare.
# Possessive runs keep the match linear and free of regex recursion.
_CELL = ',("[^"]*+(?:""[^"]*+)*+(?:"[^,]*+|$)|[^,]*+)'
_QUOTED = '^"([^"]*+(?:""[^"]*+)*+)"?(.*)$'


def strip(col: Column) -> Column:
    """Trim every kind of surrounding whitespace, not only blanks."""
    return F.btrim(col, F.lit(WHITESPACE))


def blank_to_null(col: Column) -> Column:
    return F.nullif(strip(col), F.lit(""))


def normalize_name(col: Column) -> Column:
    """Canonical spelling of a compound place name: slashes and dashes of any length become hyphens."""
    return F.translate(col, "/" + DASHES, "-" * (1 + len(DASHES)))


def split_words(col: Column) -> Column:
    """Words between runs of any whitespace, no-break spaces included (``\\s`` leaves those out)."""
    return F.split(strip(col), f"[{WHITESPACE}]+")


def place_to_file_name(col: Column) -> Column:
    return F.translate(col, "/ ", "-_")


def file_name_to_place(col: Column) -> Column:
    """Inverse of ``place_to_file_name`` as far as it can be inverted."""
    return F.translate(col, "_", " ")


def split_csv_line(line: Column) -> Column:
    """Cells of one delimited line with quotes resolved; empty cells are kept."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_CELL), F.lit(1))

    def unquote(cell: Column) -> Column:
        bare = F.replace(F.regexp_replace(cell, _QUOTED, "$1$2"), F.lit('""'), F.lit('"'))
        return F.when(cell.startswith('"'), bare).otherwise(cell)

    # Lines without a quote skip the per-cell pass.
    return F.when(F.contains(line, F.lit('"')), F.transform(raw, unquote)).otherwise(raw)


def drop_trailing_comma(line: Column) -> Column:
    """Take out one empty last cell, the mark of a trailing comma."""
    return F.regexp_replace(line, ',(?:"")?$', "")


def url_slug(url: Column) -> Column:
    """Last path segment, trailing slashes ignored."""
    return F.element_at(F.split(F.rtrim(url, F.lit("/")), "/"), -1)


def url_file_name(url: Column) -> Column:
    """Last segment of the path part, so without query string and fragment."""
    return F.element_at(F.split(F.try_parse_url(url, F.lit("PATH")), "/"), -1)
