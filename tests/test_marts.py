from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from obsengine import schemas
from obsengine.operators import marts

SCHEMA = "city string, date date, temp_max double, temp_min double, precipitation double, windspeed_max double"


@pytest.fixture
def days(spark):
    def build(*rows):
        return spark.createDataFrame(
            [(c, d, hi, lo, rain, 1.0) for c, d, hi, lo, rain in rows], SCHEMA
        )

    return build


def test_repeated_rows_count_once(days):
    rows = [("a", date(2024, 1, d), 30.0 + d, 10.0, 2.0) for d in (1, 2)]
    once, thrice = days(*rows), days(*rows * 3)
    for table in (marts.city_temperature_stats, marts.monthly_patterns, marts.extreme_events):
        assert table(once).collect() == table(thrice).collect()
    stats = marts.city_temperature_stats(thrice).first()
    assert (stats.total_precipitation, stats.days_with_rain) == (4.0, 2)


def test_rows_without_place_or_day_are_left_out(days):
    df = days((None, date(2024, 1, 1), 40.0, 1.0, 1.0), ("a", None, 40.0, 1.0, 1.0))
    assert marts.city_temperature_stats(df).isEmpty() and marts.extreme_events(df).isEmpty()


def test_event_runs(days):
    hot = [date(2024, 2, 28) + timedelta(n) for n in (0, 1, 2)]  # through 1 March
    later = [date(2024, 3, 3)]  # after a gap of one day
    df = days(
        *(("a", d, 36.0 + i, 0.0, 0.0) for i, d in enumerate([*hot, *later])),
        ("a", date(2024, 3, 2), 35.0, 0.0, 10.1),
        ("b", date(2024, 2, 29), 99.0, 0.0, 10.0),
        ("b", date(2024, 3, 1), None, 0.0, None),
    )
    rows = sorted(
        (r.city, r.event_type, str(r.event_date), r.duration_days, r.temperature_max)
        for r in marts.extreme_events(df).collect()
    )
    assert rows == [
        ("a", "heat", "2024-02-28", 3, 38.0),
        ("a", "heat", "2024-03-03", 1, 39.0),
        ("a", "heavy_rain", "2024-03-02", 1, 35.0),
        ("b", "heat", "2024-02-29", 1, 99.0),
    ]
    first = marts.extreme_events(df).orderBy("city", "event_type", "event_date").first()
    assert first.severity_score == pytest.approx(38 / 35)


def test_seasonal_pattern(days):
    df = days(
        ("a", date(2024, 1, 1), 1.0, 1.0, 10.0),
        ("a", date(2024, 2, 1), 1.0, 1.0, 0.0),
        ("b", date(2024, 1, 1), 1.0, 1.0, None),
    )
    rows = {(r.city, r.month): r.seasonal_pattern for r in marts.monthly_patterns(df).collect()}
    assert rows == {("a", 1): "Wet", ("a", 2): "Dry", ("b", 1): "Dry"}


def test_declared_schemas(days):
    df = days(("a", date(2024, 1, 1), 40.0, 1.0, 20.0))
    predictions = df.select(
        F.col("city").alias("city_name"), "date", F.col("temp_max").alias("prediction")
    )
    tables = {
        "city_temperature_stats": marts.city_temperature_stats(df),
        "monthly_patterns": marts.monthly_patterns(df),
        "extreme_events": marts.extreme_events(df),
        "ml_predictions": marts.ml_predictions(predictions, "v1"),
    }
    for name, table in tables.items():
        assert table.dtypes == [
            (f.name, f.dataType.simpleString()) for f in schemas.RESULT_TABLES[name].fields
        ]
        assert table.count() >= 1


def test_summary_from_year(days):
    df = days(("a", date(2022, 1, 1), 40.0, 1.0, 300.0), ("a", date(2023, 1, 1), 10.0, 1.0, 150.0))
    rows = marts.weather_summary(marts.city_temperature_stats(df)).collect()
    assert [(r.year, r.temperature_category, r.precipitation_category) for r in rows] == [
        (2023, "Cold", "Medium")
    ]
