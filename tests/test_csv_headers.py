"""Listing files of many columns and many headers."""

import os

from jobsift.plans.load import load_folder
from jobsift.schema import LISTING_COLUMNS
from jobsift.sources import listing_csv as csvio
from jobsift.sources import store as st

ROW = {"listing_id": "{i}", "source": "Indeed", "title": '"Dev, ""{i}"""', "company": "Acme", "link": "l", "time_when_scraped": "2024-01-01 08:00:00",
       "location": '"a\nb"', "compensation": ""}


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(text)


def _file(path, columns, ids, surplus="", bom=""):
    lines = [bom + ",".join(columns)] + [",".join(ROW.get(c, "x").format(i=i) for c in columns) + surplus for i in ids]
    _write(path, "\n".join(lines) + "\n")


def test_any_number_of_columns(spark, tmp_dir):
    """30 columns more, before, between and after the 8; also 400 more."""
    d = tmp_dir + "/drop"
    wide = [f"x{i}" for i in range(10)] + LISTING_COLUMNS[:4] + [f"y{i}" for i in range(10)] + LISTING_COLUMNS[4:] + [f"z{i}" for i in range(10)]
    _file(d + "/Indeed_20240101_0800.csv", wide, [1, 2])
    _file(d + "/Indeed_20240101_0900.csv", [f"w{i}" for i in range(400)] + LISTING_COLUMNS[::-1], [3])
    _file(d + "/Indeed [a]_20240101_1000.csv", LISTING_COLUMNS, [4], bom="﻿")
    load_folder(spark, d, tmp_dir + "/store", "b", tmp_dir + "/out")
    got = {r.listing_id: r for r in st.read_listings(spark, tmp_dir + "/store").collect()}
    assert set(got) == {"1", "2", "3", "4"}
    assert all(r.title == f'Dev, "{i}"' and r.location == "a\nb" and r.compensation is None for i, r in got.items())
    assert {(r.file_name, r.outcome) for r in spark.read.parquet(tmp_dir + "/out").collect()} == {
        ("Indeed_20240101_0800.csv", "LOADED"), ("Indeed_20240101_0900.csv", "LOADED"), ("Indeed [a]_20240101_1000.csv", "LOADED")}


def test_surplus_fields_and_missing_columns(spark, tmp_dir):
    d = tmp_dir + "/drop"
    _file(d + "/A_20240101_0800.csv", LISTING_COLUMNS, [1], surplus=",more")
    _file(d + "/B_20240101_0800.csv", LISTING_COLUMNS, [2], surplus=",,,")  # empty fields are no values
    _file(d + "/C_20240101_0800.csv", LISTING_COLUMNS[:-2], [3])
    errors = {r.listing_id: r.file_error for r in csvio.read_listings_csv(spark, csvio.top_level_csv(d)).collect()}
    assert errors == {"1": "more fields than the header", "2": None, "3": "no column location, compensation"}


def test_one_header_is_read_without_python(spark, tmp_dir):
    d = tmp_dir + "/drop"
    for k in range(3):
        _file(f"{d}/A_2024010{k + 1}_0800.csv", LISTING_COLUMNS, [k])
    df = csvio.read_listings_csv(spark, csvio.top_level_csv(d))
    assert "MapInArrow" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 3


def test_many_headers_and_headers_over_two_lines(spark, tmp_dir, monkeypatch):
    d = tmp_dir + "/drop"
    for k in range(5):
        _file(f"{d}/A_2024010{k + 1}_0800.csv", [*LISTING_COLUMNS[k:], f"extra{k}", *LISTING_COLUMNS[:k]], [k])
    want = {(str(k), f'Dev, "{k}"') for k in range(5)}
    assert {(r.listing_id, r.title) for r in csvio.read_listings_csv(spark, csvio.top_level_csv(d)).collect()} == want
    monkeypatch.setattr(csvio, "HEADERS", 3)
    assert {(r.listing_id, r.title) for r in csvio.read_listings_csv(spark, csvio.top_level_csv(d)).collect()} == want
    monkeypatch.undo()
    _write(d + "/B_20240101_0800.csv", '"two\nlines",' + ",".join(LISTING_COLUMNS) + "\nx,9,Indeed,Dev,Acme,l,2024-01-01 08:00:00,,\n")
    got = csvio.read_listings_csv(spark, csvio.top_level_csv(d)).collect()
    assert {r.listing_id for r in got} == {"0", "1", "2", "3", "4", "9"} and all(r.file_error is None for r in got)
