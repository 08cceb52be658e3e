"""Fields taken from fetched pages and response bodies."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymart.constants import EMPTY_BODY_MARKERS, EMPTY_BODY_PREFIX_BYTES
from tallymart.functions.text import LINE_BREAK, strip

_TITLE = r"(?s)<h1[^>]*>(.*?)</h1>"
_TAG = r"<[^>]+>"


def page_title(html: Column) -> Column:
    """Text of the first level-one heading, tags out, whitespace collapsed; null without one."""
    text = F.regexp_replace(F.regexp_extract(html, _TITLE, 1), _TAG, "")
    return F.when(html.rlike(_TITLE), strip(F.regexp_replace(text, r"[\s\p{Z}\x{85}]+", " ")))


def _sorted_links(html: Column, pattern: str, group: int) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(html, F.lit(pattern), F.lit(group))))


def asset_links(html: Column, host: str) -> Column:
    """Download links (.xlsx, .xls, .csv) below ``host``, distinct and sorted."""
    pattern = rf"""(?i)({re.escape(host)}/[^"'<> ]+?\.(?:xlsx|xls|csv))"""
    return _sorted_links(html, pattern, 1)


def leaf_links(html: Column, prefix: str) -> Column:
    """Links exactly one path segment below ``prefix``, distinct and sorted."""
    return _sorted_links(html, rf'href="({re.escape(prefix)}/[^"/?#]+)"', 1)


def non_blank_lines(body: Column) -> Column:
    return F.size(F.filter(F.split(body, LINE_BREAK), lambda line: strip(line) != ""))


def is_empty_body(content: Column) -> Column:
    """A marker text within the first bytes says there is no table."""
    head = F.decode(F.substring(content.cast("binary"), 1, EMPTY_BODY_PREFIX_BYTES), "ISO-8859-1")
    found = F.lit(False)
    for marker in EMPTY_BODY_MARKERS:
        found = found | F.contains(head, F.lit(marker))
    return found


def body_outcome(status: Column, content: Column) -> Column:
    """``http_<status>`` from 400 on, else ``empty`` or ``ok``."""
    return (
        F.when(status >= 400, F.concat(F.lit("http_"), status.cast("string")))
        .when(is_empty_body(content), "empty")
        .otherwise("ok")
    )
