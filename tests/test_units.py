import pytest

from foliospark.functions.automaton import AliasFinder
from foliospark.operators import units

SCHEMA = "obs_id bigint, place_id int, units string, time string, temperature double, wind_speed double, precipitation double, temperature_unit string, wind_speed_unit string, precipitation_unit string, remark string, unit string"


def weather(spark, rows):
    """Rows of (obs_id, time, units, temperature, its unit, remark); the column ``unit`` clashes with one of the
    operator's.
    """
    return spark.createDataFrame(
        [(i, 1, u, t, v, None, None, n, None, None, r, "x") for i, t, u, v, n, r in rows], SCHEMA
    )


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("sensor NOR-81C, nhiệt độ is 75,9℉", {"temperature": (75.9, "fahrenheit")}),
        ("T 54 degC x10", {"temperature": (54.0, "decicelsius")}),
        ("P: 0.94 [\"]; temp in K", {"precipitation": (0.94, "inches"), "temperature": (None, "kelvin")}),
        (
            "lượng mưa: 69.0 [1/100 inch], wind: 23,2 kmh",
            {"precipitation": (69.0, "hundredths_inch"), "wind_speed": (23.2, "kilometres_per_hour")}
        ),
        ("humidity 59%; đo lại lần 2", {}),
        (
            "rainfall in cm. W=9,9KM/H",
            {"precipitation": (None, "centimetres"), "wind_speed": (9.9, "kilometres_per_hour")}
        ),
        ("", {}), (None, {}),
    ],
)
def test_remarks(text, wanted):
    assert units.RemarkReader().read(text) == wanted


def test_longest_alias_wins():
    found = AliasFinder([("c", 1), ("degc", 2), ("degc x10", 3)]).find("5 degc x10, c")
    assert [m for _, _, m in found] == [3, 1]


def test_readings(spark):
    rows = [
        (1, "2014-01-01T10:00", "metric", 281.15, " kelvin ", None),
        (2, "2014-01-01 10:00:00.000", "imperial", 46.4, None, None),
        (2, "2014-01-01T10:00:00", "imperial", 46.4, None, None),
        (3, "2014-01-01T10:00", "metric", None, "n/a", "temp=80 [0.1 degC]"),
        (4, "2014-01-01T10:00", "metric", float("nan"), None, None), (5, None, "metric", 8.0, "C", None),
        (6, "2014-01-01T10:15", "metric", 8.0, "-", "T in F"),
    ]
    got = {r["obs_id"]: r for r in units.readings(weather(spark, rows)).collect()}
    assert {k: round(v["value"], 6) for k, v in got.items()} == {1: 8.0, 2: 8.0, 3: 8.0, 5: 8.0, 6: round(-24 / 1.8, 6)}
    assert got[6]["unit"] == "fahrenheit" and got[2]["minute"] == "2014-01-01 10:00"
    pairs = {(r[0], r[1]) for r in units.agreeing(weather(spark, rows)).collect()}
    assert pairs == {(1, 2), (1, 3), (2, 3)}


def test_agreeing_at_the_edge(spark):
    rows = [
        (1, "2014-01-01T10:00", "metric", 10.0, "C", None), (2, "2014-01-01T10:00", "metric", 283.65, "K", None),
        (3, "2014-01-01T10:00", "metric", 283.67, "K", None), (4, "2014-01-01T10:00", "metric", 10.2, "celsius", None)
    ]
    assert {(r[0], r[1]) for r in units.agreeing(weather(spark, rows)).collect()} == {(1, 2), (2, 4), (3, 4)}


def test_empty(spark):
    empty = weather(spark, [])
    assert units.convert(empty).collect() == [] and units.agreeing(empty).collect() == []


def test_agreeing_over_a_grid(spark):
    """Every pair at the limit is found: Fahrenheit by tenths against Celsius by halves, and a small bin width."""
    rows = [(i, "2014-01-01T10:00", "metric", round(-10 + i * 0.1, 1), "F", None) for i in range(600)]
    rows += [(1000 + i, "2014-01-01T10:00", "metric", -25 + i * 0.5, "C", None) for i in range(100)]
    c = {i: (v - 32) / 1.8 if n == "F" else v for i, _, _, v, n, _ in rows}
    for within in (0.5, 0.05):
        wanted = {(a, b) for a in range(600) for b in range(1000, 1100) if abs(c[a] - c[b]) <= within + 1e-9}
        assert {(r[0], r[1]) for r in units.agreeing(weather(spark, rows), within).collect()} == wanted
    rows = [
        (1, "2014-01-01T10:00", "metric", 19.4, "F", None), (2, "2014-01-01T10:00", "metric", -6.5, "C", None),
        (3, "2014-01-01T10:00", "metric", -7.5, "C", None)
    ]
    assert {(r[0], r[1]) for r in units.agreeing(weather(spark, rows)).collect()} == {(1, 2), (1, 3)}


def test_unit_columns():
    reader = units.RemarkReader()
    wanted = {
        (" DegC X10 ", "temperature"): "decicelsius", ("(°F)", "temperature"): "fahrenheit",
        ("km/h", "temperature"): None, ("n/a", "wind_speed"): None, ("", "precipitation"): None,
        ("0.01 in.", "precipitation"): "hundredths_inch", ("in", "precipitation"): "inches"
    }
    assert {k: reader.unit(*k) for k in wanted} == wanted
