from datetime import datetime, timezone

import pytest

from cedarloom.functions.instants import offset_intervals
from cedarloom.operators.instants import normalise_instants


def us(*a):
    return int(datetime(*a, tzinfo=timezone.utc).timestamp() * 1_000_000)


CASES = [
    ("2019-07-01T12:00:00", us(2019, 7, 1, 16), "ok"),
    ("2019-01-01", us(2019, 1, 1, 5), "ok"),
    ("2018-11-04 01:30:00", us(2018, 11, 4, 5, 30), "ambiguous"),
    ("2018-03-11 02:30", None, "nonexistent"),
    ("2018-11-04 01:30 EST", us(2018, 11, 4, 6, 30), "ok"),
    ("2020-01-18T17:07:18+05:30", us(2020, 1, 18, 11, 37, 18), "ok"),
    ("20190329T192733Z", us(2019, 3, 29, 19, 27, 33), "ok"),
    ("20190329", us(2019, 3, 29, 4), "ok"),
    ("1716441519", 1716441519000000, "ok"),
    ("1575331309733", 1575331309733000, "ok"),
    ("43038.25", us(2017, 10, 30, 10), "ok"),
    ("Wed, 13 Nov 2019 20:47:45 -0500", us(2019, 11, 14, 1, 47, 45), "ok"),
    ("1er décembre 2022", us(2022, 12, 1, 5), "ok"),
    ("20-May-21", us(2021, 5, 20, 4), "ok"),
    ("Mar 28, 2023 1:20 pm", us(2023, 3, 28, 17, 20), "ok"),
    ("999999999000", us(2001, 9, 9, 1, 46, 39), "ok"),
    ("999999999000000", us(2001, 9, 9, 1, 46, 39), "ok"),
    ("10000000000", us(2286, 11, 20, 17, 46, 40), "ok"),
    ("9999", us(1927, 5, 17, 4), "ok"),
    ("59", us(1900, 2, 28, 5), "ok"),
    ("61", us(1900, 3, 1, 5), "ok"),
    ("2019", us(2019, 1, 1, 5), "ok"),
    ("201907", us(2019, 7, 1, 4), "ok"),
    ("-86400000", us(1967, 4, 7), "ok"),
    ("-5", None, "unreadable"),
    ("1899-12-31", us(1899, 12, 31, 5), "ok"),
    ("1850-01-01", us(1850, 1, 1, 5, 17, 32), "ok"),
    ("1750-01-01", us(1750, 1, 1, 5, 17, 32), "ok"),
    ("2101-01-01", us(2101, 1, 1, 5), "ok"),
    ("2150-07-01", us(2150, 7, 1, 4), "ok"),
    ("2400-03-12 02:30", None, "nonexistent"),
    ("2400-11-05 01:30", us(2400, 11, 5, 5, 30), "ambiguous"),
    ("2021-02-30", None, "unreadable"),
    ("13/45/2020", None, "unreadable"),
    ("2020-01-01 25:00", None, "unreadable"),
    ("", None, "unreadable"),
    (None, None, "unreadable"),
    ("x" * 5000, None, "unreadable"),
]


def test_values(spark):
    df = spark.createDataFrame([(i, t, "f") for i, (t, _, _) in enumerate(CASES)], "id int, s string, y string")
    got = {r["id"]: (r["utc_us"], r["time_status"]) for r in normalise_instants(df, "s", ["y"]).collect()}
    for i, (text, want, status) in enumerate(CASES):
        assert got[i] == (want, status), text


def test_order_of_slashed_dates_is_that_of_the_file(spark):
    rows = [(1, "02/03/2019", "a"), (2, "25/03/2019", "a"), (3, "02/03/2019", "b"), (4, "03/25/2019", "a"), (5, "02/03/2019", None), (5, "02/03/2019", None)]
    df = spark.createDataFrame(rows, "id int, raw string, file string")
    got = sorted((r["id"], r["utc_us"]) for r in normalise_instants(df, "raw", ["file"]).where("utc_us is not null").collect())
    assert got == [(1, us(2019, 3, 2, 5)), (2, us(2019, 3, 25, 4)), (3, us(2019, 2, 3, 5)), (5, us(2019, 2, 3, 5)), (5, us(2019, 2, 3, 5))]


def test_empty(spark):
    df = spark.createDataFrame([], "id int, raw string, file string")
    assert normalise_instants(df, "raw", ["file"]).count() == 0


@pytest.mark.parametrize("year,n", [(2019, 3), (1950, 3), (2100, 3)])
def test_intervals_cover_the_year(year, n):
    spans = dict(offset_intervals("America/Toronto"))[year]
    assert len(spans) == n
    assert all(a[1] - a[2] == b[0] - b[2] for a, b in zip(spans, spans[1:], strict=False))
