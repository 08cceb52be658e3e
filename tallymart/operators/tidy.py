"""Exported table files -> long observations, for any number of files in one job.

Two ways to find a file's table, with equal results:

* one row per file (``tidy_files``): everything about a file is an array expression
  on its own row, so the job has no shuffle at all.  For files that fit a row.
* one row per line (``tidy_lines``): per-file facts are partial aggregates joined
  back on the file, so a file of any size stays spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.constants import PLACE_BREAKDOWNS
from tallymart.functions import is_value_token, parse_period, split_csv_line, strip, subtitle_period
from tallymart.functions.text import LINE_BREAK, drop_trailing_comma
from tallymart.operators.reshape import LONG_COLUMNS, header_slots, ragged_to_long
from tallymart.operators.spread import join_facts

REJECT_REASON = "No data table found"


def file_lines(content: Column) -> Column:
    """Lines of a file; a UTF-8 byte-order mark before the first is not part of it (the text source drops it too)."""
    return F.split(F.regexp_replace(F.decode(content, "ISO-8859-1"), "^\u00ef\u00bb\u00bf", ""), LINE_BREAK)


def first_position(flags: Column) -> Column:
    """1-based position of the first true flag, 0 without one."""
    return F.coalesce(F.array_position(flags, F.lit(True)).cast("int"), F.lit(0))


def _is_blank(line: Column) -> Column:
    return strip(line) == ""


def _lists_places(breakdown: Column) -> Column:
    return F.coalesce(breakdown.isin(*PLACE_BREAKDOWNS), F.lit(False))


def _snapshot_cells(line: Column) -> Column:
    return split_csv_line(drop_trailing_comma(strip(line)))


def _is_snapshot_pair(head: Column, data: Column, head_line: Column, data_line: Column) -> Column:
    """A header line directly over a line of as many numbers or null tokens."""
    return F.coalesce(
        (F.size(head) >= 2) & (F.size(head) == F.size(data))
        & ~strip(head_line).startswith(",") & ~strip(data_line).startswith(",")
        & F.forall(data, is_value_token),
        F.lit(False),
    )


def _no_codes(label: Column) -> Column:
    return F.lit(False)


def _indexed(cells: Column) -> Column:
    """Snapshot cells with the index cell they lack."""
    return F.concat(F.array(F.lit("")), cells)


def _first_cell(cells: Column) -> Column:
    return F.coalesce(strip(F.get(cells, F.lit(0))), F.lit(""))


def _shape(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Data rows (slots, cells, places, dated, file_period, any_filled) -> the long contract.

    ``dated`` says that the whole file has one period, ``places`` that the index is a place.
    """
    index = _first_cell(F.col("cells"))
    resolved = rows.where((index != "") | ~F.col("any_filled")).select(
        *keys,
        F.when(F.col("dated"), F.col("file_period")).otherwise(parse_period(index)).alias("period"),
        F.when(F.col("places"), F.nullif(index, F.lit(""))).alias("sub_geography"),
        "slots", "cells",
    )
    return ragged_to_long(resolved).select(*keys, *LONG_COLUMNS)


# --- one row per file ---------------------------------------------------------
#
# Each step is a projection over the arrays of the step before.  No step filters on
# a computed column (a pushed-down filter would compute it twice): a file without a
# table of one form has null there, and the generator drops it.


def _located(files: DataFrame, keys: list[str]) -> DataFrame:
    """``start``: line of the leading-comma header, 0 without one; ``at``: line of a snapshot header."""
    lines, rows, n = F.col("lines"), F.col("rows"), F.size(F.col("lines"))
    pairs = F.arrays_zip(
        rows.alias("head"), F.slice(rows, F.lit(2), n).alias("data"),
        lines.alias("head_line"), F.slice(lines, F.lit(2), n).alias("data_line"),
    )
    matches = F.transform(
        pairs, lambda p: _is_snapshot_pair(p["head"], p["data"], p["head_line"], p["data_line"])
    )
    return (
        files.select(*keys, "breakdown", file_lines(F.col("content")).alias("lines"))
        .withColumn("start", first_position(F.transform(lines, lambda s: s.startswith(","))))
        .withColumn("rows", F.when(F.col("start") == 0, F.transform(lines, _snapshot_cells)))
        .withColumn("at", first_position(matches))
    )


def table_rows(files: DataFrame, keys: list[str]) -> DataFrame:
    """Every data row with its file's column slots and facts."""
    lines, rows, start, at, body = (F.col(c) for c in ("lines", "rows", "start", "at", "body"))
    is_matrix = start > 0
    n = F.size(lines)
    body_end = first_position(F.transform(body, _is_blank))
    body_rows = F.when(body_end > 0, body_end - 1).otherwise(F.size(body))
    above = F.slice(lines, F.lit(1), F.greatest(F.when(is_matrix, start).otherwise(at) - 1, F.lit(0)))
    subtitle = F.try_element_at(F.filter("above", lambda s: ~_is_blank(s)), F.lit(-1))
    stamps = F.filter(F.transform(F.reverse(F.col("above")), parse_period), lambda p: p.isNotNull())
    header, table = F.col("header"), F.col("table")
    return (
        _located(files, keys)
        .withColumn("body", F.when(is_matrix, F.slice(lines, F.greatest(start, F.lit(1)), n)))
        .withColumn("body_rows", body_rows)
        .withColumn("above", above)
        .withColumn("subtitle", subtitle)
        .select(
            *keys, is_matrix.alias("is_matrix"), _lists_places(F.col("breakdown")).alias("lists_places"),
            F.when(is_matrix, split_csv_line(F.get(body, F.lit(0)))).otherwise(_indexed(F.get(rows, at - 1))).alias("header"),
            F.when(is_matrix, F.transform(F.slice(body, F.lit(2), F.col("body_rows") - 1), split_csv_line))
            .when(at > 0, F.array(_indexed(F.get(rows, at)))).alias("table"),
            F.when(is_matrix, subtitle_period(F.col("subtitle"))).otherwise(F.get(stamps, F.lit(0))).alias("file_period"),
        )
        .select(
            *keys, "table", "file_period",
            (F.col("is_matrix") & F.col("lists_places")).alias("places"),
            (~F.col("is_matrix") | F.col("lists_places")).alias("dated"),
            F.when(F.col("is_matrix"), header_slots(header)).otherwise(header_slots(header, _no_codes)).alias("slots"),
            F.coalesce(F.exists(table, lambda r: _first_cell(r) != ""), F.lit(False)).alias("any_filled"),
        )
        .select(*keys, "slots", "places", "dated", "file_period", "any_filled",
                F.explode(F.coalesce(table, F.array())).alias("cells"))
    )


def tidy_files(files: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, breakdown, content) -> keys + the five long columns; one pass, no shuffle."""
    return _shape(table_rows(files, keys), keys)


def rejected_files(files: DataFrame, keys: list[str]) -> DataFrame:
    """Files holding no table in either form; one bad file never stops the others."""
    return _located(files, keys).where((F.col("start") == 0) & (F.col("at") == 0)).select(
        *keys, F.lit(REJECT_REASON).alias("reason")
    )


# --- one row per line ---------------------------------------------------------


def rejected_lines(lines: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    """``rejected_files`` for files read by line."""
    heads = lines.where(F.col("line").startswith(",")).select(*keys).distinct()
    loose = join_facts(lines, heads, keys, "left_anti")
    found = heads.unionByName(_snapshot_pairs(loose, keys).select(*keys))
    return files.select(*keys).distinct().join(found, keys, "left_anti").select(*keys, F.lit(REJECT_REASON).alias("reason"))


def _snapshot_pairs(loose: DataFrame, keys: list[str]) -> DataFrame:
    """First header line directly over a line of values, per file.

    Neighbouring lines meet on (file, pos): that key spreads a huge file over all tasks.
    """
    pos = F.col("pos")
    return (
        loose.select(*keys, "pos", F.col("line").alias("head_line"))
        .join(loose.select(*keys, (pos - 1).alias("pos"), F.col("line").alias("data_line")), [*keys, "pos"])
        .withColumn("head", _snapshot_cells(F.col("head_line")))
        .withColumn("data", _snapshot_cells(F.col("data_line")))
        .where(_is_snapshot_pair(F.col("head"), F.col("data"), F.col("head_line"), F.col("data_line")))
        .groupBy(*keys)
        .agg(F.min("pos").alias("at"), F.min_by(F.struct("head", "data"), F.col("pos")).alias("pair"))
    )


def tidy_lines(lines: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, pos, line) with gapless ``pos``, and (keys, breakdown) per file."""
    pos, line = F.col("pos"), F.col("line")
    heads = (
        lines.where(line.startswith(","))
        .groupBy(*keys)
        .agg(F.min("pos").alias("start"), F.min_by(line, pos).alias("header_line"))
    )
    bounds = (
        join_facts(lines, heads, keys)
        .groupBy(*keys, "start", "header_line")
        .agg(
            F.min(F.when(_is_blank(line) & (pos > F.col("start")), pos)).alias("end"),
            F.max_by(line, F.when(~_is_blank(line) & (pos < F.col("start")), pos)).alias("subtitle"),
        )
        .withColumn("slots", header_slots(split_csv_line(F.col("header_line"))))
        .withColumn("file_period", subtitle_period(F.col("subtitle")))
        .drop("header_line", "subtitle")
    )
    block = (
        join_facts(lines, bounds, keys)
        .where((pos > F.col("start")) & (F.col("end").isNull() | (pos < F.col("end"))))
        .select(*keys, "slots", "file_period", split_csv_line(line).alias("cells"))
    )
    flags = block.groupBy(*keys).agg(F.max(_first_cell(F.col("cells")) != "").alias("any_filled"))
    places = files.select(*keys, _lists_places(F.col("breakdown")).alias("places"))
    facts = flags.join(places.withColumn("dated", F.col("places")), keys)
    matrix = join_facts(block, facts, keys)

    loose = join_facts(lines, heads.select(*keys), keys, "left_anti")
    pairs = _snapshot_pairs(loose, keys)
    stamp = F.when(pos < F.col("at"), parse_period(line))
    snapshots = (
        join_facts(loose, pairs, keys)
        .groupBy(*keys)
        .agg(
            F.max_by(stamp, F.when(stamp.isNotNull(), pos)).alias("file_period"),
            F.min(F.struct("at", "pair")).alias("first"),
        )
        .select(
            *keys, header_slots(_indexed(F.col("first.pair.head")), _no_codes).alias("slots"), "file_period",
            _indexed(F.col("first.pair.data")).alias("cells"), F.lit(False).alias("any_filled"),
            F.lit(False).alias("places"), F.lit(True).alias("dated"),
        )
    )
    return _shape(matrix.unionByName(snapshots), keys)
