import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gleanery.operators import timestamps as ts


def utc(reading, zone="UTC"):
    got = ts.to_utc(pd.Series([reading]), pd.Series([zone]))[0]
    return None if pd.isna(got) else int(got)


NOON = 1273057659  # 2010-05-05 11:07:39 UTC


@pytest.mark.parametrize(
    "reading",
    [
        "2010-05-05T11:07:39Z", "2010-05-05 11:07:39", "05-05-2010 11:07:39", "05.05.2010 11:07:39", "05/05/2010 11:07:39 AM", "20100505T110739Z", "1273057659", "1273057659980", "1273057659980123", "2010-05-05 11:07:39.999999",
        "2010-05-05T13:07:39+02:00[Europe/Madrid]", "2010-05-05 16:52:39 +0545", "2010-05-05T08:07:39-03", "5 May 2010 11:07:39", "Wed, 05 May 2010 07:07:39 -0400", "5 de mayo de 2010, 11:07:39", "Wed May  5 11:07:39 2010", "05-05-2010 13:07:39 CEST", " 2010-05-05 11:07:39 UTC ",
    ],
)
def test_one_instant_in_many_forms(reading):
    assert utc(reading) == NOON


@pytest.mark.parametrize("reading", ["", None, "n/a", "2010-05-05", "05-05-2010", "31-02-2010 10:00:00", "2010-13-01 10:00:00", "25:00", "2010-05-05 24:00:00", "2010-05-05 10:61:00", "01-01-1970 00:00:00", "1970-01-01 00:00:00", "0000-00-00 00:00:00", "yesterday, 10:41", "??-??-2013 10:20", "0", "13/13/2010 10:00:00 AM", "05/05/2010 13:00:00 PM", "x" * 100_000, "2010-05-05 10:00:00 QQQ"])
def test_no_instant(reading):
    assert utc(reading) is None


def test_slashes_put_the_month_first_and_missing_seconds_are_zero():
    assert utc("05/06/2010 01:10:24 AM") == utc("2010-05-06 01:10:24")
    assert utc("06-05-2010 01:10") == utc("2010-05-06 01:10:00")
    assert utc("12/31/2010 12:00:00 AM") == utc("2010-12-31 00:00:00")


def test_clock_changes():
    assert utc("28-10-2012 02:17:37", "Europe/Madrid") is None  # twice
    assert utc("2012-03-25 02:39:04", "Europe/Madrid") is None  # never
    assert utc("28-10-2012 03:00:00", "Europe/Madrid") == utc("2012-10-28 02:00:00")
    assert utc("28-10-2012 02:17:37 CEST", "Europe/Madrid") == utc("2012-10-28 00:17:37")
    assert utc("2010-05-05 11:07:39", None) is None
    assert utc("2010-05-05 11:07:39", "No/Where") is None


@settings(max_examples=60, deadline=None)
@given(st.integers(86400, 4_102_000_000), st.sampled_from(["Europe/Madrid", "America/New_York", "Australia/Sydney", "Asia/Kathmandu", "Asia/Tokyo"]))
def test_transition_tables_agree_with_the_zone_data(second, zone):
    from datetime import datetime, timezone
    from zoneinfo import ZoneInfo

    there = datetime.fromtimestamp(second, timezone.utc).astimezone(ZoneInfo(zone))
    local = second + int(there.utcoffset().total_seconds())
    got, ok = ts.zone_to_utc(np.array([local]), zone)
    both = {int((datetime.fromtimestamp(local, timezone.utc).replace(tzinfo=ZoneInfo(zone), fold=f)).timestamp()) for f in (0, 1)}
    assert bool(ok[0]) == (len(both) == 1)
    assert not ok[0] or got[0] == second


def test_same_second_pairs(spark):
    rows = [("a", 1, "2010-05-05 11:07:39", "UTC", "x"), ("a", 2, "1273057659", "UTC", "x"), ("a", 3, "05-05-2010 11:07:39.9", "UTC", None), ("b", 4, "1273057659", "UTC", "x"), (None, 5, "1273057659", "UTC", "x"), ("a", 6, None, "UTC", "x"), ("a", 7, "2010-05-05", None, "x"), ("a", 7, "2010-05-05", None, "x")]
    df = spark.createDataFrame(rows, "grp string, id long, reading string, zone string, utc string")
    inst = ts.normalise(df, "reading", "zone", ["grp", "id"])
    assert inst.count() == len(rows)
    assert {(r.key_a, r.key_b) for r in ts.same_second(inst, ["grp"], "id").collect()} == {(1, 2), (1, 3), (2, 3)}
    empty = ts.normalise(df.limit(0), "reading", "zone", ["grp", "id"])
    assert ts.same_second(empty, ["grp"], "id").count() == 0


def test_years_without_a_table_are_looked_up_one_by_one():
    assert utc("01-07-2150 12:00:00", "Europe/Madrid") == utc("2150-07-01 10:00:00")
    assert utc("01-07-1850 12:00:00") == utc("1850-07-01 12:00:00") and utc("01-07-1850 12:00:00") < utc("01-07-1950 12:00:00")
    assert utc("31-10-2150 02:30:00", "Europe/Madrid") is not None or utc("25-10-2150 02:30:00", "Europe/Madrid") is None
    assert utc("0001-01-01 00:00:00", "Asia/Tokyo") is None or utc("0001-01-01 00:00:00", "Asia/Tokyo") < 0


def test_another_version_of_the_zone_data_is_refused():
    here = ts.tz_version()
    assert here and ts.transitions("Europe/Madrid", here) is not None
    with pytest.raises(RuntimeError):
        ts.to_utc(pd.Series(["05-05-2010 11:07:39"]), pd.Series(["Europe/Madrid"]), "1999z")


def test_one_parser_for_each_mask():
    ts._PARSERS.clear()
    readings = pd.Series([f"{d:02d} May 2010 11:07:{s:02d} PM" for d in range(1, 20) for s in range(50)])
    first = ts.to_utc(readings, pd.Series(["UTC"] * len(readings)))
    assert first.notna().all() and len(ts._PARSERS) == 1
    kept = next(iter(ts._PARSERS.values()))
    assert ts.to_utc(readings, pd.Series(["UTC"] * len(readings))).equals(first) and next(iter(ts._PARSERS.values())) is kept


def test_classes_are_the_pairs_in_short(spark):
    rows = [("a", k, 100 + k % 3) for k in range(9)] + [("a", 20, None), (None, 21, 100), ("b", 22, 100), ("b", 22, 100)]
    df = spark.createDataFrame(rows, "grp string, id long, utc_second long")
    assert {(r.grp, r.utc_second, r.class_id, r.n_rows) for r in ts.second_classes(df, ["grp"], "id").collect()} == {("a", 100, 0, 3), ("a", 101, 1, 3), ("a", 102, 2, 3), ("b", 100, 22, 2)}
    assert ts.second_classes(df.limit(0), ["grp"], "id").count() == 0
