from datetime import date

import pytest

from tallymart.operators.matrix import MATRIX_COLUMNS, Recipe, default_recipes, matrix_long, recipe_frame


def run(spark, sheets, recipe, title="Test Metric", first=None):
    rows = [("f", s, i, [None if c is None else str(c) for c in cells]) for s, grid in sheets.items() for i, cells in enumerate(grid)]
    grid = spark.createDataFrame(rows, "file string, sheet string, row_idx long, cells array<string>")
    tables = spark.createDataFrame(
        [("f", first or next(iter(sheets)), "Test Survey", "fake-table", title, recipe.slug)],
        "file string, first_sheet string, survey string, table_id string, title string, slug string",
    ).join(recipe_frame(spark, [recipe]), "slug")
    out = matrix_long(grid, tables)
    assert out.columns == list(MATRIX_COLUMNS)
    return out.collect()


def test_single_sheet(spark):
    rows = run(spark, {"Cargo": [
        ["Cargo per berth"], ["tonnes"], [], ["Geography", "2014Q1", "2014Q2", "2014Q3"], ["Eastmark", 5.5, "..", 6],
        ["Inner harbours"], ["Port Lark", 1.25, 2.5, "x"], ["See the handbook"],
    ]}, Recipe("x", "period"), title="Cargo")
    assert {(r.geography, r.period, r.value) for r in rows} == {
        ("Eastmark", date(2014, 1, 1), 5.5), ("Eastmark", date(2014, 4, 1), None), ("Eastmark", date(2014, 7, 1), 6.0),
        ("Port Lark", date(2014, 1, 1), 1.25), ("Port Lark", date(2014, 4, 1), 2.5), ("Port Lark", date(2014, 7, 1), None)}
    assert {(r.category, r.survey, r.table_id, r.source) for r in rows} == {("Cargo", "Test Survey", "fake-table", "static")}


def test_sheet_per_period(spark):
    sheets = {
        "Readme": [["about this book"]],
        "2019": [["Berths"], ["Harbour", "Deep", "Shallow", "Dry"], ["Eastmark", 14, 3, 1], ["Port Lark", 6, "[x]", 2]],
        "2009": [["Harbour", "Deep", "Shallow", "Dry"], ["Eastmark", 11, 4, 0]],
        "Chart": [["Harbour", "Deep", "Shallow", "Dry"], ["Eastmark", 1, 1, 1]],
    }
    rows = run(spark, sheets, Recipe("x", "category", sheet_dimension="period", skip_sheets=("Readme",), header_marker="Harbour"))
    assert {(r.period.year, r.geography, r.category, r.value) for r in rows} == {
        (2019, "Eastmark", "Deep", 14.0), (2019, "Eastmark", "Shallow", 3.0), (2019, "Eastmark", "Dry", 1.0),
        (2019, "Port Lark", "Deep", 6.0), (2019, "Port Lark", "Shallow", None), (2019, "Port Lark", "Dry", 2.0),
        (2009, "Eastmark", "Deep", 11.0), (2009, "Eastmark", "Shallow", 4.0), (2009, "Eastmark", "Dry", 0.0)}


@pytest.mark.parametrize("marker", ["Geography", None])
def test_sheet_per_category_with_codes(spark, marker):
    def sheet(scale):
        return [["Crews"], ["Geography", "2011", "Grade (see notes)", "remark", "2012", "Grade (see notes)"],
                ["Eastmark", 40 * scale, "c ", "text", "1,250", None], ["Port Lark", "**", "d", "text", 7 * scale, "a "]]

    rows = run(spark, {"Readme": [["x"]], "Deck": sheet(1), "Engine": sheet(2)},
               Recipe("x", "period", sheet_dimension="category", skip_sheets=("Readme",), header_marker=marker, code_label="Grade"))
    assert {(r.category, r.geography, r.period.year, r.value, r.reliability) for r in rows} == {
        (name, *rest) for name, scale in (("Deck", 1), ("Engine", 2)) for rest in (
            ("Eastmark", 2011, 40.0 * scale, "c"), ("Eastmark", 2012, 1250.0, None), ("Port Lark", 2011, None, "d"), ("Port Lark", 2012, 7.0 * scale, "a"))}


def test_place_hidden_in_one_sheet_only(spark):
    def sheet(value):
        return [["Harbour", "Deep"], ["Eastmark", 1], ["Port Lark", value]]

    rows = run(spark, {"2019": sheet("x"), "2009": sheet(3)},
               Recipe("x", "category", sheet_dimension="period", header_marker="Harbour"))
    assert {(r.geography, r.period.year) for r in rows} == {("Eastmark", 2019), ("Eastmark", 2009), ("Port Lark", 2009)}


def test_registry():
    recipes = default_recipes()
    assert len(recipes) == len({r.slug for r in recipes}) == 18
    assert sum(r.sheet_dimension is None for r in recipes) == 12
