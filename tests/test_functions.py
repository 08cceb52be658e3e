import csv
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymart import functions as fn


def evaluate(spark, values, build, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", build(F.col("v")).alias("out"))
    return [r.out for r in df.orderBy("i").collect()]


PERIODS = [
    ("Jan 1990", date(1990, 1, 1)), ("Feb 1990", date(1990, 2, 1)), ("Dec 2025", date(2025, 12, 1)),
    ("1990 March", date(1990, 3, 1)), ("1991 October", date(1991, 10, 1)), ("2026 January", date(2026, 1, 1)),
    ("1990/Q1", date(1990, 1, 1)), ("1990/Q2", date(1990, 4, 1)), ("1990/Q3", date(1990, 7, 1)), ("1990/Q4", date(1990, 10, 1)),
    ("2006", date(2006, 1, 1)), ("1990", date(1990, 1, 1)), ("2025", date(2025, 1, 1)),
    (None, None), ("", None), ("   ", None), ("just a string", None), ("1800", None), ("99999", None), ("1990/Q5", None),
    ("Sept 1990", date(1990, 9, 1)), ("sEPtember  1990", date(1990, 9, 1)), ("\xa02021\t", date(2021, 1, 1)),
    ("1990 /Q1", None), ("Janu 1990", None), ("Jan 0", None), ("Jan 12345", None), ("2101", None), ("02021", date(2021, 1, 1)),
    ("Jan 1990 x", None), ("1990 1991", None), ("Jan Feb", None), ("1990/q1", None),
]


def test_parse_period(spark):
    assert evaluate(spark, [p for p, _ in PERIODS], fn.parse_period) == [e for _, e in PERIODS]


GRID_PERIODS = [
    ("2012Q3", date(2012, 7, 1)), ("2012/Q1", date(2012, 1, 1)), ("2012 Q2", date(2012, 4, 1)), ("2012 / Q4", date(2012, 10, 1)),
    ("2021", date(2021, 1, 1)), (None, None), ("Notes", None), ("2012Q5", None), ("1899", None), ("12Q1", None), ("2012Q12", None),
    ("Feb 1990", None), ("2012//Q1", None),
]


def test_parse_grid_period(spark):
    assert evaluate(spark, [p for p, _ in GRID_PERIODS], fn.parse_grid_period) == [e for _, e in GRID_PERIODS]


def test_subtitle_period(spark):
    cases = [
        ("October 2025 Row / Apartment", date(2025, 10, 1)), ("October 2025 Row / Apartment Bedroom Type - Total", date(2025, 10, 1)),
        ("1990 to 2025 Row / Apartment October", date(1990, 1, 1)), ("Row / Apartment", None), (" 2021 ", date(2021, 1, 1)),
        ("1991/Q2 Row", date(1991, 4, 1)), (None, None),
    ]
    assert evaluate(spark, [c for c, _ in cases], fn.subtitle_period) == [e for _, e in cases]


def test_parse_number(spark):
    cases = [
        ("1,234.5", 1234.5), ("0.38", 0.38), ("6,367", 6367.0), (" 12 ", 12.0), ("-3", -3.0), ("1e3", 1000.0), (".5", 0.5),
        ("**", None), ("", None), ("n/a", None), ("..", None), ("-", None), (None, None), ("1d", None), ("1f", None),
        ("NaN", None), ("Infinity", None), ("abc", None), ("1 2", None),
    ]
    assert evaluate(spark, [c for c, _ in cases], fn.parse_number) == [e for _, e in cases]


def test_null_tokens_and_comma_order(spark):
    tokens = ("", "x", "[x]", "7")
    assert evaluate(spark, [",x,", "[x]", "1,234.5", "7,"], lambda c: fn.parse_grid_number(c, tokens)) == [None, None, 1234.5, None]
    assert evaluate(spark, ["7,"], lambda c: fn.parse_number(c, tokens)) == [7.0]  # token test before commas go
    assert evaluate(spark, ["...", "x", "[x]"], fn.parse_grid_number) == [None] * 3


def test_value_token(spark):
    assert evaluate(spark, ["1,2", "**", " ", "Source"], fn.is_value_token) == [True, True, True, False]


def test_round_half_even(spark):
    assert evaluate(spark, [2.5, 3.5, -2.5, 2.4, None], fn.round_to_int, "double") == [2, 4, -2, 2, None]


def test_names(spark):
    names = ["Guelph/Eramosa (TP)", "Greater Sudbury / Grand Sudbury (CV)", "Toronto", None]
    once = evaluate(spark, names, fn.normalize_name)
    assert once == ["Guelph-Eramosa (TP)", "Greater Sudbury - Grand Sudbury (CV)", "Toronto", None]
    assert evaluate(spark, once, fn.normalize_name) == once
    assert evaluate(spark, ["A/B c"], fn.place_to_file_name) == ["A-B_c"]
    assert evaluate(spark, ["A-B_c"], fn.file_name_to_place) == ["A-B c"]
    assert evaluate(spark, ["A\u2013B/C", "D\u2014E"], fn.normalize_name) == ["A-B-C", "D-E"]
    assert evaluate(spark, ["October\u00a02025", "1990 \u00a0March"], fn.parse_period) == [date(2025, 10, 1), date(1990, 3, 1)]
    assert evaluate(spark, ["October\u00a02025\u00a0Row / Apartment"], fn.subtitle_period) == [date(2025, 10, 1)]


def test_urls(spark):
    urls = ["https://x.org/a/b-c/", "https://x.org/f/file.xlsx?rev=1#top"]
    assert evaluate(spark, urls, fn.url_slug)[0] == "b-c"
    assert evaluate(spark, urls, fn.url_file_name)[1] == "file.xlsx"


def test_page_fields(spark):
    html = '<h1 class="t">\n Rental <b>market</b>\n  data </h1><a href="/t/rental/a">x</a><a href="/t/rental/a/b">y</a>' \
           '<a href="https://assets.x.org/f/B.XLSX">f</a><a href="https://assets.x.org/f/a.csv">g</a><a href="https://assets.x.org/f/a.csv">g</a>'
    assert evaluate(spark, [html, "<p>none</p>"], fn.page_title) == ["Rental market data", None]
    assert evaluate(spark, [html], lambda c: fn.leaf_links(c, "/t/rental")) == [["/t/rental/a"]]
    assert evaluate(spark, [html], lambda c: fn.asset_links(c, "https://assets.x.org")) == [
        ["https://assets.x.org/f/B.XLSX", "https://assets.x.org/f/a.csv"]
    ]


def test_body_outcome(spark):
    bodies = ["ok\r\n\r\nx", "No data available.", "x" * 1990 + "No data available", "This data series is now archived"]
    assert evaluate(spark, bodies, lambda c: fn.body_outcome(F.lit(200), F.encode(c, "UTF-8"))) == ["ok", "empty", "ok", "empty"]
    assert evaluate(spark, bodies[:1], lambda c: fn.body_outcome(F.lit(500), F.encode(c, "UTF-8"))) == ["http_500"]
    assert evaluate(spark, bodies[:1], fn.non_blank_lines) == [2]


CELL = st.text(alphabet=st.sampled_from('ab ,"$é1'), max_size=6)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(CELL, min_size=1, max_size=6), min_size=1, max_size=20))
def test_split_csv_line_agrees_with_quoting(spark, table):
    """Any cells written with standard quoting come back unchanged."""
    def write(cells):
        return ",".join('"' + c.replace('"', '""') + '"' if "," in c or '"' in c else c for c in cells)

    lines = [write(cells) for cells in table]
    assert evaluate(spark, lines, fn.split_csv_line) == [next(csv.reader([line]), [""]) or [""] for line in lines]


@pytest.mark.parametrize("line", ['a,"b', 'a,"b"c,d', 'a"b,c', ",", "", '"x ""y""",', 'a,""'])
def test_split_csv_line_edges(spark, line):
    assert evaluate(spark, [line], fn.split_csv_line) == [next(csv.reader([line]), [""]) or [""]]


def test_long_quoted_cell_does_not_overflow(spark):
    cell = 'x""' * 20_000
    assert len(evaluate(spark, [f'"{cell}",1'], fn.split_csv_line)[0][0]) == 40_000
