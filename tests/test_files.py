"""Files that are appended once, and cells that cannot be read."""

import datetime as dt

import pytest
from logs import write as write_logs

from skillframe.plans.ingest import read_refused
from skillframe.sources.files import Dialect, conform_observed, refusals, refused_cells
from skillframe.sources.incremental import Layout, append_dialects

SCHEMA = {"at": "timestamp_ntz", "who": "string", "amount": "double"}
ISO = Dialect("iso")
US = Dialect("us", {"when": "at"}, "M/d/yyyy H:mm")
LAYOUTS = [Layout(ISO, "iso-*.csv", ["at", "who", "amount"]), Layout(US, "us-*.csv", ["amount", "when", "who"])]


@pytest.fixture
def place(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def put(place, name, *lines):
    (place / "in" / name).write_text("\n".join(lines) + "\n")


def append(spark, place):
    return append_dialects(spark, str(place / "in"), LAYOUTS, SCHEMA, str(place / "out"), str(place / "state"))


def rows(spark, place):
    return sorted((r["file_name"], r["who"], r["amount"], r["at"]) for r in spark.read.parquet(str(place / "out")).collect())


def test_each_file_is_appended_once(spark, place):
    put(place, "iso-1.csv", "at,who,amount", "2020-01-02 03:04:05,a,1.5", "2020-01-02 03:04:06,b,2")
    assert append(spark, place) == 2
    assert append(spark, place) == 0
    put(place, "us-1.csv", "amount,when,who", "3,1/2/2020 3:04,c")
    put(place, "other.txt", "at,who,amount", "2020-01-02 03:04:05,x,9")
    assert append(spark, place) == 1
    assert append(spark, place) == 0
    assert rows(spark, place) == [
        ("iso-1.csv", "a", 1.5, dt.datetime(2020, 1, 2, 3, 4, 5)), ("iso-1.csv", "b", 2.0, dt.datetime(2020, 1, 2, 3, 4, 6)),
        ("us-1.csv", "c", 3.0, dt.datetime(2020, 1, 2, 3, 4))]


def test_a_run_that_ended_before_its_commit_doubles_nothing(spark, place):
    put(place, "iso-1.csv", "at,who,amount", "2020-01-02 03:04:05,a,1.5")
    append(spark, place)
    before = rows(spark, place)
    for name in ("0", ".0.crc"):
        (place / "state" / "commits" / name).unlink(missing_ok=True)
    append(spark, place)
    assert rows(spark, place) == before


def test_an_old_file_that_comes_late_is_not_lost(spark, place):
    import os

    put(place, "iso-2.csv", "at,who,amount", "2020-01-02 03:04:05,b,2")
    append(spark, place)
    put(place, "iso-1.csv", "at,who,amount", "2019-01-02 03:04:05,a,1")
    os.utime(place / "in" / "iso-1.csv", (1e9, 1e9))
    assert append(spark, place) == 1
    assert [r[1] for r in rows(spark, place)] == ["a", "b"]


def test_another_header_is_an_error_and_adds_nothing(spark, place):
    put(place, "iso-1.csv", "at,who,amount", "2020-01-02 03:04:05,a,1.5")
    append(spark, place)
    put(place, "iso-2.csv", "at,amount,who", "2020-01-02 03:04:05,2,b")
    with pytest.raises(Exception, match="(?i)header"):
        append(spark, place)
    assert [r[1] for r in rows(spark, place)] == ["a"]


@pytest.fixture
def cells(spark):
    return spark.createDataFrame(
        [("f", "1/2/2020 3:04", "a", "1"), ("f", "2020-01-02", "b", "x"), ("f", None, "c", None), ("g", "1/2/2020 3:04", "d", "1,5"),
         (None, "soon", "e", "NaN")],
        "file_name string, when string, who string, amount string")


def test_only_cells_with_text_are_refused(spark, cells):
    got = sorted(map(tuple, refused_cells(cells, US, SCHEMA).collect()), key=str)
    assert got == [("f", "amount", "x"), ("f", "at", "2020-01-02"), ("g", "amount", "1,5"), (None, "at", "soon")]
    counts = {tuple(r)[:2]: tuple(r)[2:] for r in refusals(cells, US, SCHEMA).collect()}
    assert counts == {("f", "at"): (3, 1), ("f", "amount"): (3, 1), ("g", "at"): (1, 0), ("g", "amount"): (1, 1),
                      (None, "at"): (1, 1), (None, "amount"): (1, 0)}


def test_counts_come_with_the_rows(spark, cells):
    typed, seen = conform_observed(cells, US, SCHEMA, ["file_name"])
    assert typed.columns == ["at", "who", "amount", "file_name"]
    assert len(typed.collect()) == 5
    assert dict(seen.get) == {"rows": 5, "at": 2, "amount": 2}


def test_columns_of_text_or_none_are_never_refused(spark, cells):
    assert refused_cells(cells, US, {"who": "string", "gone": "double"}).collect() == []
    assert refusals(cells, US, {"who": "string"}).collect() == []
    assert refusals(cells.limit(0), US, SCHEMA).collect() == []


def test_cells_of_a_season_that_cannot_be_read(spark, tmp_path):
    write_logs(tmp_path)
    folder = tmp_path / "csvs"
    assert read_refused(spark, str(folder)).count() == 0
    path = folder / "phs_2020_1.csv"
    lines = path.read_text().splitlines()
    lines[1] = lines[1].rsplit(",", 1)[0] + ",many"
    path.write_text("\n".join(lines) + "\n")
    assert [tuple(r) for r in read_refused(spark, str(folder)).collect()] == [("phs_2020_1.csv", "stat_amount", "many")]
