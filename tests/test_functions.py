"""Column functions on hand-made values."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from conftest import values
from fieldlab.functions import geo, numbers, text, times


def apply(frame, make, *inputs, kind="string"):
    df = frame(f"i int, v {kind}", *enumerate(inputs))
    return [r[0] for r in df.orderBy("i").select(make("v")).collect()]


def test_to_number(frame):
    got = apply(frame, numbers.to_number, "12", " 12 ", "1e3", "-.5", "1d", "2f", "12 mm", "", "NaN", None)
    assert got == [12.0, 12.0, 1000.0, -0.5, None, None, None, None, None, None]


def test_sum_numbers(frame):
    assert apply(frame, text.sum_numbers, "2 RB, 1 CT", "none", None, "3x4") == [3.0, 0.0, None, 7.0]


def test_serial_day_and_clock(frame):
    assert apply(frame, times.serial_date, "45292.75", "1", "soon", None) == [
        dt.date(2024, 1, 1), dt.date(1899, 12, 31), None, None]
    assert apply(frame, times.serial_seconds, "45292.75", "0.5", "x") == [64800, 43200, None]
    assert apply(frame, lambda c: times.clock_text(c), 64800, 59, kind="int") == ["18:00:00", "00:00:59"]


@pytest.mark.parametrize(
    ("shift", "expected"),
    [
        ("1: 8:00-14:00", (28800, 50400, 6.0)),
        ("08:00:00-14:00:00", (28800, 50400, 6.0)),
        ("22:00-02:00", (79200, 7200, -20.0)),
        ("late", (None, None, None)),
        (None, (None, None, None)),
    ],
)
def test_shift_parts(frame, shift, expected):
    parts = times.shift_parts("s")
    assert values(frame("s string", (shift,)).select(*parts.values())) == [expected]


def test_dates(frame):
    assert apply(frame, lambda c: times.parse_date(c, "mdy"), " 5/7/2024 ", "05-07-2024", "x") == [
        dt.date(2024, 5, 7), dt.date(2024, 5, 7), None]
    assert apply(frame, lambda c: times.parse_date(c, "dmy"), "7/5/2024") == [dt.date(2024, 5, 7)]
    assert apply(frame, lambda c: times.parse_date(c, "ymd"), "2024/5/7", "2024-05-07") == [dt.date(2024, 5, 7)] * 2
    assert apply(frame, times.clock_seconds, "7:05", "07:05:09", "25") == [25500, 25509, None]
    assert apply(frame, times.undo_auto_date, "45787", "5-10", "calm", None) == ["5-10", "5-10", "calm", None]
    assert apply(frame, times.or_missing_time, None, "9:00") == ["12:01", "9:00"]


def test_text(frame):
    assert apply(frame, text.after_dash, "VR2W-69-112", "VR2W", None) == ["69-112", None, None]
    assert apply(frame, text.digit_count, "54a3", "") == [3, 0]
    assert apply(frame, text.commas, "bass; trout and ct or rb") == ["bass, trout , ct , rb"]
    assert apply(frame, text.fragments, "Nest destroyed.  Fry captured. . ") == [["Nest destroyed", "Fry captured"]]
    assert apply(frame, text.tidy_activity, ". Nest destroyed. . Fry captured..") == ["Nest destroyed. Fry captured."]
    assert apply(frame, text.tidy, "\t SMB \n") == ["smb"]


def test_species_spelling_is_stable(frame):
    spell = lambda c: text.spelled(c, text.SPECIES_SPELLINGS)
    assert apply(frame, spell, "northern pikeminnow", "pikeminow", "smb", "carp") == [
        "northern pikeminnow", "northern pikeminnow", "smallmouth bass", "carp"]
    assert not set(text.SPECIES_SPELLINGS.values()) & set(text.SPECIES_SPELLINGS)


def test_categorise_first_match_wins(frame):
    reason = lambda c: text.categorise(c, text.SITE_REASONS)
    assert apply(frame, reason, "Small mouth bass here", "FISHING nearby", "we live close", "bbq", "?", None) == [
        "SMB / bass", "Fishing", "Proximity", "Recreation / Relaxation", "Other", "Other"]


def test_nest_activity_and_labels(frame):
    df = frame("a string, b string", ("Y", "N"), ("N (prev Y)", "n/a"), (None, "Y (3)"), ("n/a", None))
    assert values(df.select(text.nest_activity("a", "b"))) == sorted([
        ("Nest destroyed. No fry captured.",), ("Nest not destroyed.",), ("Three fry captured.",), ("",)], key=str)
    labels = text.labelled({"Air Temp": "a", "Wind": "b"})
    assert values(frame("a string, b string", ("12", None)).select(labels)) == [("Air Temp: 12 Wind: ",)]


def test_coordinates(frame):
    got = apply(frame, geo.ddm_to_degrees, "49 03.500 N", "121 58.800 W", "x")
    assert got[:2] == pytest.approx([49 + 3.5 / 60, -(121 + 58.8 / 60)]) and got[2] is None
    assert apply(frame, geo.coordinate_kind, "49.05", "5434567", " ", None) == ["degrees", "utm", "blank", "blank"]
    pair = frame("a string, b string", ("5434567", "574321"), ("574321", "5434567"))
    assert values(pair.select(*geo.ordered_utm("a", "b"))) == [(574321.0, 5434567.0)] * 2
    lat, lon = geo.split_pair("c")
    assert values(frame("c string", ("49.05N 121.98W",)).select(lat, lon)) == [(49.05, 121.98)]


def test_haversine(frame):
    df = frame("lat double, lon double", (geo.LAKE_LAT, geo.LAKE_LON), (geo.LAKE_LAT + 1, geo.LAKE_LON))
    got = [r[0] for r in df.select(geo.haversine_km("lat", "lon")).collect()]
    assert got == pytest.approx([0, math.radians(1) * 6378.137])


def test_utm_control_points(frame):
    """On the central meridian easting is 500 km and northing 0.9996 of the meridian arc."""
    east, north = geo.lonlat_to_utm("lon", "lat")
    df = frame("lon double, lat double", (-123.0, 0.0), (-123.0, 45.0), (-121.978, 49.0679))
    rows = df.select(east.alias("e"), north.alias("n")).collect()
    assert rows[0] == pytest.approx((500000, 0), abs=1e-6)
    # Length of the WGS84 meridian from the equator to 45 degrees.
    assert rows[1] == pytest.approx((500000, 0.9996 * 4984944.378), abs=0.01)
    back = frame("e double, n double", *[tuple(r) for r in rows]).select(*geo.utm_to_lonlat("e", "n"))
    assert [c for r in back.collect() for c in r] == pytest.approx([-123, 0, -123, 45, -121.978, 49.0679], abs=1e-9)


def test_dates_out_of_range_and_short_years(frame):
    df = frame("s string", ("99999999999",), ("1e300",), ("-1e9",), ("45292.5",))
    assert values(df.select(times.serial_date("s"), times.serial_seconds("s"))) == sorted(
        [(None, None)] * 3 + [(dt.date(2024, 1, 1), 43200)], key=str)
    clocks = frame("s string", ("25:75",), ("24:00",), ("23:59:59",), ("24:01",), ("7:05",))
    assert values(clocks.select(times.clock_seconds("s"))) == sorted([(None,), (86400,), (86399,), (None,), (25500,)], key=str)
    short = frame("s string", ("5/1/24",), ("5/1/69",), ("05-01-2024",))
    assert values(short.select(times.parse_date("s", "mdy"))) == [(dt.date(1969, 5, 1),), (dt.date(2024, 5, 1),), (dt.date(2024, 5, 1),)]
