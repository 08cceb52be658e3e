"""Workbook grids -> long observations, driven by a table of parse recipes.

Input contract: one row per sheet row, ``(file, sheet, row_idx, cells)``, plus one
recipe row per file.  Recipes are data joined in, so one job covers all layouts.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import asdict, dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.constants import (
    CODE_COLUMN_LABEL,
    GRID_NULL_TOKENS,
    SHEET_PER_CATEGORY_SLUGS,
    SHEET_PER_PERIOD_SLUGS,
    SINGLE_SHEET_SLUGS,
    SKIPPED_SHEETS,
)
from tallymart.functions import parse_grid_number, parse_grid_period, strip
from tallymart.operators.reshape import drop_dividers, header_slots, ragged_to_long
from tallymart.session import local_frame

MATRIX_COLUMNS = (
    "period", "sub_geography", "category", "value", "reliability",
    "survey", "table_id", "geography", "source",
)
_DEFAULT_SHEET = r"(?i)^sheet\d*$"


@dataclass(frozen=True)
class Recipe:
    """How to read one workbook table."""

    slug: str
    axis: str                              # column headers are a "period" or a "category"
    sheet_name: str | None = None          # the single sheet to read; None = the first one
    sheet_dimension: str | None = None     # per-sheet tables: the name is a "period" or a "category"
    skip_sheets: tuple[str, ...] = ()
    header_marker: str | None = None       # first cell of the header row; None = look for periods
    code_label: str | None = None          # part of a code column's header
    metric: str | None = None              # fixed category; None = the table's title
    null_tokens: tuple[str, ...] = GRID_NULL_TOKENS  # cells that mean "no number here"


RECIPE_SCHEMA = (
    "slug string, axis string, sheet_name string, sheet_dimension string, "
    "skip_sheets array<string>, header_marker string, code_label string, metric string, null_tokens array<string>"
)


def default_recipes() -> list[Recipe]:
    single = [Recipe(slug, "period") for slug in SINGLE_SHEET_SLUGS]
    by_period = [
        Recipe(slug, "category", sheet_dimension="period", skip_sheets=SKIPPED_SHEETS, header_marker=marker)
        for slug, marker in SHEET_PER_PERIOD_SLUGS.items()
    ]
    by_category = [
        Recipe(slug, "period", sheet_dimension="category", skip_sheets=SKIPPED_SHEETS,
               header_marker=marker, code_label=CODE_COLUMN_LABEL)
        for slug, marker in SHEET_PER_CATEGORY_SLUGS.items()
    ]
    return single + by_period + by_category


def recipe_frame(spark: SparkSession, recipes: Iterable[Recipe] | None = None) -> DataFrame:
    names = [f.name for f in fields(Recipe)]
    rows = [
        tuple(list(v) if isinstance(v, tuple) else v for v in (asdict(r)[n] for n in names))
        for r in (default_recipes() if recipes is None else recipes)
    ]
    return local_frame(spark, rows, RECIPE_SCHEMA)


def select_sheets(grid: DataFrame) -> DataFrame:
    """Rows of the sheets a recipe reads; ``first_sheet`` names a file's first sheet."""
    name, dimension = F.col("sheet"), F.col("sheet_dimension")
    single = name == F.coalesce(F.col("sheet_name"), F.col("first_sheet"))
    per_sheet = (
        ~F.array_contains(F.col("skip_sheets"), name)
        & ~name.rlike(_DEFAULT_SHEET)
        & ((dimension != "period") | parse_grid_period(name).isNotNull())
    )
    return grid.where(F.when(dimension.isNull(), single).otherwise(per_sheet))


def is_header_row(cells: Column, axis: Column, marker: Column) -> Column:
    """The marker in the first cell, or (period axis, no marker) two period-like later cells."""
    later = F.slice(cells, F.lit(2), F.greatest(F.size(cells) - 1, F.lit(0)))
    n_periods = F.size(F.filter(later, lambda c: parse_grid_period(c).isNotNull()))
    return F.when(marker.isNotNull(), strip(F.get(cells, F.lit(0))) == marker).otherwise(
        (axis == "period") & (n_periods >= 2)
    )


def header_rows(grid: DataFrame) -> DataFrame:
    """First header row of every sheet: (file, sheet, header_idx, header)."""
    return (
        grid.where(is_header_row(F.col("cells"), F.col("axis"), F.col("header_marker")))
        .groupBy("file", "sheet")
        .agg(F.min("row_idx").alias("header_idx"), F.min_by("cells", "row_idx").alias("header"))
    )


def headerless_sheets(grid: DataFrame, tables: DataFrame) -> DataFrame:
    """Selected sheets in which no row is a header: (file, sheet, reason); they yield no observation."""
    chosen = select_sheets(grid.join(tables, "file"))
    return chosen.select("file", "sheet").distinct().join(header_rows(chosen).select("file", "sheet"), ["file", "sheet"], "left_anti").withColumn(
        "reason", F.lit("No header row found"))


def _is_code(label: Column) -> Column:
    return F.coalesce(F.contains(F.lower(label), F.lower(F.col("code_label"))), F.lit(False))


def _is_kept(label: Column) -> Column:
    by_axis = F.when(F.col("axis") == "period", parse_grid_period(label).isNotNull()).otherwise(strip(label) != "")
    return F.coalesce(_is_code(label) | by_axis, F.lit(False))


def matrix_long(grid: DataFrame, tables: DataFrame) -> DataFrame:
    """``grid`` rows ⨝ ``tables`` (file, first_sheet, survey, table_id, title + recipe fields) -> long.

    Everything that holds for a whole sheet (column slots, periods, labels) is worked
    out once, on its header row; data rows meet it on (file, sheet).
    """
    by_period = F.col("axis") == "period"
    sheet_period = F.when(F.col("sheet_dimension") == "period", parse_grid_period(F.col("sheet")))
    sheet_category = F.when(F.col("sheet_dimension") == "category", F.col("sheet"))
    label = F.coalesce(sheet_category, F.col("metric"), F.col("title"), F.lit(""))
    sheets = (
        header_rows(select_sheets(grid.join(tables, "file"))).join(tables, "file")
        .withColumn("sheet_period", sheet_period)
        .withColumn("sheet_label", label)
        .withColumn("slots", header_slots(F.col("header"), _is_code, _is_kept))
        .select(
            "file", "sheet", "header_idx", "survey", "table_id", "null_tokens",
            F.transform("slots", lambda s: F.struct(
                F.when(by_period, parse_grid_period(s["category"])).otherwise(F.col("sheet_period")).alias("period"),
                F.when(by_period, F.col("sheet_label")).otherwise(s["category"]).alias("category"),
                s["at"].alias("at"), s["code_at"].alias("code_at"),
            )).alias("slots"),
        )
    )
    body = (
        grid.join(sheets, ["file", "sheet"]).where(F.col("row_idx") > F.col("header_idx"))
        .select("file", "sheet", "survey", "table_id", "null_tokens", strip(F.get("cells", F.lit(0))).alias("geography"), "slots", "cells")
    )
    # A recipe without tokens of its own keeps the usual ones.
    tokens = F.coalesce(F.col("null_tokens"), F.array(*(F.lit(t) for t in GRID_NULL_TOKENS)))
    number = lambda cell: parse_grid_number(cell, tokens)
    any_value = F.exists("slots", lambda s: number(F.get("cells", s["at"])).isNotNull())
    placed = drop_dividers(body, ["file", "sheet", "geography"], any_value)
    return ragged_to_long(placed, parse_value=number, carry=("period", "category")).select(
        "period", F.lit(None).cast("string").alias("sub_geography"), "category", "value", "reliability",
        "survey", "table_id", "geography", F.lit("static").alias("source"),
    )
