"""Wide matrices -> long observations.

A value column may be followed by a column of quality codes.  Both melts are a
single pass: one generated row per value column, no repeated scans, no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions import blank_to_null, parse_number, strip
from tallymart.operators.spread import join_facts

LONG_COLUMNS = ("period", "sub_geography", "category", "value", "reliability")


def pair_columns(columns: Sequence[str], is_code: Callable[[str], bool]) -> list[tuple[str, str | None]]:
    """Each value column with the code column directly after it; stray code columns are left out."""
    following = [*columns[1:], None]
    return [
        (name, nxt if nxt is not None and is_code(nxt) else None)
        for name, nxt in zip(columns, following)
        if not is_code(name)
    ]


def wide_to_long(
    df: DataFrame,
    index: str,
    *,
    is_code: Callable[[str], bool],
    parse_value: Callable[[Column], Column] = parse_number,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Melt a frame whose columns are known: ``keep``, ``index``, category, value, reliability."""
    value_columns = [c for c in df.columns if c != index and c not in keep]
    cells = [
        F.struct(
            F.lit(name.strip()).alias("category"),
            df[f"`{name}`"].alias("raw_value"),
            (df[f"`{code}`"] if code is not None else F.lit(None).cast("string")).alias("raw_code"),
        )
        for name, code in pair_columns(value_columns, is_code)
    ]
    return df.select(*keep, strip(df[f"`{index}`"]).alias(index), F.inline(F.array(*cells))).select(
        *keep,
        index,
        "category",
        parse_value(F.col("raw_value")).alias("value"),
        blank_to_null(F.col("raw_code")).alias("reliability"),
    )


def is_blank_header(header: Column) -> Column:
    return F.coalesce(header == "", F.lit(True))


def header_slots(
    header: Column,
    is_code: Callable[[Column], Column] = is_blank_header,
    is_kept: Callable[[Column], Column] | None = None,
) -> Column:
    """Value columns of a header array: label, position, and position of the code column if any.

    Position 0 is the index column.  Columns failing ``is_kept`` are taken out before
    value columns look for the code column to their right.  One evaluation per header,
    not per data row.
    """
    n = F.size(header)
    columns = F.slice(
        F.transform(header, lambda label, i: F.struct(label.alias("label"), i.alias("at"))),
        F.lit(2), F.greatest(n - 1, F.lit(0)),
    )
    if is_kept is not None:
        columns = F.filter(columns, lambda c: is_kept(c["label"]))
    neighbours = F.arrays_zip(
        columns.alias("own"), F.slice(columns, F.lit(2), F.greatest(n, F.lit(1))).alias("right")
    )
    values = F.filter(neighbours, lambda p: p["own"].isNotNull() & ~is_code(p["own"]["label"]))
    return F.transform(
        values,
        lambda p: F.struct(
            strip(p["own"]["label"]).alias("category"),
            p["own"]["at"].alias("at"),
            F.when(p["right"].isNotNull() & is_code(p["right"]["label"]), p["right"]["at"]).alias("code_at"),
        ),
    )


def ragged_to_long(
    rows: DataFrame, *, slots: str = "slots", cells: str = "cells",
    parse_value: Callable[[Column], Column] = parse_number, carry: Sequence[str] = ("category",),
) -> DataFrame:
    """Melt rows of cells by the ``header_slots`` they carry; other columns are kept.

    ``carry`` names the slot fields that become columns.  Cells beyond the header are ignored, missing cells read as null.
    """
    texts = F.col(cells)
    picked = F.transform(
        F.col(slots),
        lambda s: F.struct(
            *(s[field].alias(field) for field in carry),
            F.get(texts, s["at"]).alias("raw_value"),
            F.get(texts, s["code_at"]).alias("raw_code"),
        ),
    )
    others = [c for c in rows.columns if c not in (slots, cells)]
    # Cells are parsed after the generator, inside whole-stage codegen.
    return rows.select(*others, F.inline(picked)).select(
        *others,
        *carry,
        parse_value(F.col("raw_value")).alias("value"),
        blank_to_null(F.col("raw_code")).alias("reliability"),
    )


def drop_summary_rows(df: DataFrame, group: Sequence[str], index: str) -> DataFrame:
    """Drop blank-index rows of a group that also has indexed rows, else null the index.

    The per-group flag is a partial aggregate, joined back with a salt, so a group holding
    most rows is never gathered in one task.
    """
    filled = F.coalesce(strip(F.col(index)) != "", F.lit(False))
    flags = df.groupBy(*group).agg(F.max(filled).alias("any_filled"))
    return (
        join_facts(df, flags, group)
        .where(filled | ~F.col("any_filled"))
        .withColumn(index, F.when(filled, F.col(index)))
        .drop("any_filled")
    )


def drop_dividers(df: DataFrame, group: Sequence[str], has_value: Column | None = None) -> DataFrame:
    """Keep only groups with a value somewhere; suppressed cells of such a group stay.

    Works on long rows, or on whole rows of cells with a test for any value in them.
    """
    has_value = F.col("value").isNotNull() if has_value is None else has_value
    alive = df.where(has_value).select(*(F.col(g).alias(f"_{g}") for g in group)).distinct()
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group]
    return df.join(alive, reduce(and_, same), "left_semi")
