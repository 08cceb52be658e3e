"""Table files in all their forms, through both lanes."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallymart.functions.text import LINE_BREAK
from tallymart.operators import reshape, tidy

TS = "Historical Time Periods"
# Invented shipping figures; each file shows one trait of a published table.
FILES = {
    "plain": (TS, b' Departures by Vessel \r\n2003 to 2019\r\n\r\n,Ferry,Barge,Sum,\r\nMar 2003,"1,205",31,"1,236",\r\n'
                  b'Apr 2003,998,"2,040","3,038",\r\n\r\nRemarks\r\nSource,Harbour office\r\n'),
    "coded": (TS, b' Delays \r\n2001 to 2018 Day boats\r\n\r\n,Short,,Medium,,Any,,\r\n2001 May,4.5,c ,6.25,b ,5.0,a ,\r\n'
                  b'2002 May,**,b ,7.5,d ,6.0,c ,\r\n\r\nRemarks\r\n'),
    "places": ("Provinces", b"\r\n,Open,Shut,\r\nNorthmark,12,7,\r\nSouthmark,30,0,\r\n\r\n"),
    "summary": (None, b"\r\n,P,Q,\r\nAug 2011,8,6,\r\n,80,60,\r\n\r\n"),
    "subtitle": ("Provinces", b" Berths by Depth\r\nApril 2016 Sheltered / Open water\r\n,Under 5 m,,Over 5 m,,\r\n"
                              b"Southmark,9,b ,3,a ,\r\nNorthmark,4,c ,2,d ,\r\n,13,a ,5,b ,\r\n\r\nRemarks\r\n"),
    "single": ("Census Subdivision", b' Fees\r\nApril 2016 Sheltered / Open water\r\n,Dinghy,,Sloop,,Any,,\r\n,"2,310",c ,**,,"3,005",b ,\r\n\r\nRemarks\r\n'),
    "nothing": (TS, b"Heading\r\nNo data available.\r\n"),
    "accents": ("Provinces", b"\r\n,boats,\r\nBras d'Or-\xcele,5,\r\n"),
    "snapshot": (None, b' Moorings \r\n2014\r\nBuoy,Quay,Unknown,All,\r\n"3,201",88,"1,000","4,289",\r\n\r\nSource,Harbour office\r\n'),
    "quoted": (None, b' Heading \r\n2014\r\n"Up to 2,000 kg","2,001 kg - 9,000 kg","Any",\r\n41.5,50.5,92.0,\r\n'),
    "undated": (None, b" Heading \r\nK,L,\r\n5,6,\r\n"),
    "breaks": (TS, b"t\r,A,B,\x0cJan 1990,1,\x85Feb 1990,3,4,5,6\r\r,9,9\r"),
}


@pytest.fixture(scope="module")
def files(spark):
    rows = [(name, breakdown, bytearray(content)) for name, (breakdown, content) in FILES.items()]
    return spark.createDataFrame(rows, "name string, breakdown string, content binary").cache()


def by_file(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.name, set()).add((r.period, r.sub_geography, r.category, r.value, r.reliability))
    return out


@pytest.fixture(scope="module", params=["row lane", "line lane"])
def long(request, spark, files):
    if request.param == "row lane":
        df = tidy.tidy_files(files, ["name"])
    else:
        lines = files.select("name", F.posexplode(tidy.file_lines(F.col("content"))).alias("pos", "line"))
        df = tidy.tidy_lines(lines, files, ["name"])
    assert df.columns == ["name", *reshape.LONG_COLUMNS]
    assert dict(df.dtypes) == {"name": "string", "period": "date", "sub_geography": "string",
                               "category": "string", "value": "double", "reliability": "string"}
    return by_file(df)


def test_plain(long):
    march, april = date(2003, 3, 1), date(2003, 4, 1)
    assert long["plain"] == {
        (march, None, "Ferry", 1205.0, None), (march, None, "Barge", 31.0, None), (march, None, "Sum", 1236.0, None),
        (april, None, "Ferry", 998.0, None), (april, None, "Barge", 2040.0, None), (april, None, "Sum", 3038.0, None),
    }


def test_codes_attach_and_withheld_cells_keep_theirs(long):
    first, second = date(2001, 5, 1), date(2002, 5, 1)
    assert long["coded"] == {
        (first, None, "Short", 4.5, "c"), (first, None, "Medium", 6.25, "b"), (first, None, "Any", 5.0, "a"),
        (second, None, "Short", None, "b"), (second, None, "Medium", 7.5, "d"), (second, None, "Any", 6.0, "c"),
    }


def test_places(long):
    assert {r[1:4] for r in long["places"]} == {("Northmark", "Open", 12.0), ("Northmark", "Shut", 7.0), ("Southmark", "Open", 30.0), ("Southmark", "Shut", 0.0)}
    assert {(r[0], r[4]) for r in long["places"]} == {(None, None)}


def test_summary_row_dropped(long):
    assert long["summary"] == {(date(2011, 8, 1), None, "P", 8.0, None), (date(2011, 8, 1), None, "Q", 6.0, None)}


def test_subtitle_period(long):
    april = date(2016, 4, 1)
    assert long["subtitle"] == {(april, "Southmark", "Under 5 m", 9.0, "b"), (april, "Southmark", "Over 5 m", 3.0, "a"),
                                (april, "Northmark", "Under 5 m", 4.0, "c"), (april, "Northmark", "Over 5 m", 2.0, "d")}


def test_single_place_kept(long):
    april = date(2016, 4, 1)
    assert long["single"] == {(april, None, "Dinghy", 2310.0, "c"), (april, None, "Sloop", None, None), (april, None, "Any", 3005.0, "b")}


def test_accents(long):
    assert long["accents"] == {(None, "Bras d'Or-\u00cele", "boats", 5.0, None)}


def test_snapshot(long):
    year = date(2014, 1, 1)
    assert long["snapshot"] == {(year, None, c, v, None) for c, v in (("Buoy", 3201.0), ("Quay", 88.0), ("Unknown", 1000.0), ("All", 4289.0))}
    assert {r[2:4] for r in long["quoted"]} == {("Up to 2,000 kg", 41.5), ("2,001 kg - 9,000 kg", 50.5), ("Any", 92.0)}
    assert long["undated"] == {(None, None, "K", 5.0, None), (None, None, "L", 6.0, None)}


def test_line_ends_short_and_long_rows(long):
    jan, feb = date(1990, 1, 1), date(1990, 2, 1)
    assert long["breaks"] == {(jan, None, "A", 1.0, None), (jan, None, "B", None, None),
                              (feb, None, "A", 3.0, None), (feb, None, "B", 4.0, "5")}


def test_no_table_is_a_reject(files, long):
    assert "nothing" not in long
    assert [tuple(r) for r in tidy.rejected_files(files, ["name"]).collect()] == [("nothing", tidy.REJECT_REASON)]


def test_row_lane_has_no_shuffle(files):
    plan = tidy.tidy_files(files, ["name"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_line_break_pattern():
    import re
    assert re.split(LINE_BREAK, "a\r\nb\rc\nd\x85e") == ["a", "b", "c", "d", "e"]


def test_wide_to_long_pairs(spark):
    df = spark.createDataFrame([(" x ", "1,000", "a ", "stray", "2", "**")], ["place", " A ", "q1", "q2", "B", "C"])
    out = reshape.wide_to_long(df, "place", is_code=lambda c: c.startswith("q"))
    assert {tuple(r) for r in out.collect()} == {("x", "A", 1000.0, "a"), ("x", "B", 2.0, None), ("x", "C", None, None)}
    assert reshape.pair_columns(["q0", "A", "q1", "q2", "B"], lambda c: c.startswith("q")) == [("A", "q1"), ("B", None)]


def test_wide_to_long_reads_its_input_once(spark, tmp_path):
    spark.createDataFrame([("x", "1", "2", "3")], ["p", "A", "B", "C"]).write.parquet(str(tmp_path / "w"))
    out = reshape.wide_to_long(spark.read.parquet(str(tmp_path / "w")), "p", is_code=lambda c: False)
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_drop_summary_rows_by_group(spark):
    df = spark.createDataFrame([("f", "a"), ("f", " "), ("g", ""), ("g", None)], "g string, i string")
    out = reshape.drop_summary_rows(df, ["g"], "i")
    assert sorted((r.g, r.i) for r in out.collect() if r.g == "f") == [("f", "a")]
    assert [r.i for r in out.collect() if r.g == "g"] == [None, None]


def test_drop_dividers_keeps_suppressed_cells_and_blank_places(spark):
    df = spark.createDataFrame([("s", "a", 1.0), ("s", "a", None), ("s", "b", None), ("s", None, 2.0), ("t", None, None)],
                               "sheet string, place string, value double")
    out = reshape.drop_dividers(df, ["sheet", "place"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted([("s", "a", 1.0), ("s", "a", None), ("s", None, 2.0)], key=str)
