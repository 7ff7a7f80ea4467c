"""Rules of the derived columns at their cutoffs and on nulls."""

import pytest

from obsengine.functions import columns as fn


def values(df, name):
    return [row[name] for row in df.collect()]


def test_temperatures(frame):
    df = frame("temp_max double, temp_min double", (10.0, 4.0), (None, 4.0))
    assert values(fn.with_temp_avg(df), "temp_avg") == [7.0, None]
    assert values(fn.with_temp_range(df), "temp_range") == [6.0, None]


@pytest.mark.parametrize(
    ("kind", "temp_max", "precipitation", "threshold", "expected"),
    [
        ("temperatura", 30.1, 0.0, 30.0, True),
        ("temperatura", 30.0, 99.0, 30.0, False),
        ("temperatura", 29.9, 99.0, 30.0, False),
        ("lluvia", 0.0, 10.1, 10.0, True),
        ("lluvia", 99.0, 10.0, 10.0, False),
        ("lluvia", 99.0, None, 10.0, False),
        ("viento", 99.0, 99.0, 1.0, False),
        (None, 99.0, 99.0, 1.0, False),
        ("temperatura", None, 99.0, 1.0, False),
        ("temperatura", 99.0, 99.0, None, False),
    ],
)
def test_alert_triggered(frame, kind, temp_max, precipitation, threshold, expected):
    df = frame(
        "alert_type string, temp_max double, precipitation double, threshold_value double, is_active boolean",
        (kind, temp_max, precipitation, threshold, False),
    )
    assert values(fn.with_alert_triggered(df), "alert_triggered") == [expected]


def test_quality_score(frame):
    df = frame(
        "city_name string, station_name string", ("a", "s"), (None, "s"), ("a", None), (None, None)
    )
    assert values(fn.with_quality_score(df), "data_quality_score") == [1.0, 0.5, 0.5, 0.5]


def test_flags(frame):
    df = frame(
        "precipitation double, temp_max double",
        (5.0, 35.0),
        (5.1, 35.1),
        (10.0, None),
        (10.1, 0.0),
        (None, 99.0),
    )
    flagged = fn.with_precip_class(fn.with_flags(df))
    assert values(flagged, "high_precipitation") == [0, 0, 0, 1, 0]
    assert values(flagged, "extreme_temp") == [0, 1, 0, 0, 1]
    assert values(flagged, "precip_class") == [0, 1, 1, 1, 0]


def test_temp_category_null_is_warmest(frame):
    df = frame("temperature double", (14.9,), (15.0,), (25.0,), (29.9,), (30.0,), (None,))
    assert values(fn.with_temp_category(df), "temp_category") == [
        "Frío", "Templado", "Cálido", "Cálido", "Muy Cálido", "Muy Cálido",
    ]


def test_temp_category_needs_matching_labels(frame):
    with pytest.raises(ValueError):
        fn.with_temp_category(frame("temperature double", (1.0,)), labels=("a", "b"))


def test_summary_categories(frame):
    df = frame(
        "avg_temp_max double, total_precipitation double",
        (30.1, 200.1),
        (30.0, 200.0),
        (15.0, 100.1),
        (14.9, 100.0),
        (None, None),
    )
    out = fn.with_summary_categories(df)
    assert values(out, "temperature_category") == ["Hot", "Moderate", "Moderate", "Cold", "Moderate"]
    assert values(out, "precipitation_category") == ["High", "Medium", "Medium", "Low", "Low"]


def test_calendar(frame):
    df = frame("d string", ("2024-12-31",)).selectExpr("cast(d as date) as date")
    row = fn.with_calendar(df).first()
    assert (row.year, row.month, row.day_of_year) == (2024, 12, 366)


def test_fill_and_complete(frame):
    df = frame(
        "temp_max double, temp_min double, precipitation double, city_name string",
        (1.0, 1.0, None, "a"),
        (1.0, float("nan"), 1.0, "a"),
        (1.0, 1.0, 1.0, None),
    )
    assert values(fn.fill_zero(df, ["precipitation", "altitude"]), "precipitation") == [0.0, 1.0, 1.0]
    assert fn.complete_rows(df).count() == 1
    assert fn.available(df, ["altitude", "temp_max"]) == ["temp_max"]
