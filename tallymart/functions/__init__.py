"""Column -> Column builders; nothing in here leaves the JVM."""

from tallymart.functions.numbers import is_value_token, parse_grid_number, parse_number, round_to_int
from tallymart.functions.periods import (
    parse_grid_period,
    parse_period,
    period_label,
    period_year,
    subtitle_period,
)
from tallymart.functions.text import (
    blank_to_null,
    file_name_to_place,
    normalize_name,
    place_to_file_name,
    split_csv_line,
    strip,
    url_file_name,
    url_slug,
)
from tallymart.functions.web import asset_links, body_outcome, leaf_links, non_blank_lines, page_title

__all__ = [
    "asset_links", "blank_to_null", "body_outcome", "file_name_to_place", "is_value_token",
    "leaf_links", "non_blank_lines", "normalize_name", "page_title",
    "parse_grid_number", "parse_grid_period", "parse_number", "parse_period", "period_label",
    "period_year", "place_to_file_name", "round_to_int", "split_csv_line", "strip",
    "subtitle_period", "url_file_name", "url_slug",
]
