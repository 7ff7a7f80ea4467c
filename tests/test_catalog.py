from datetime import date

import pytest

from obsengine.operators import marts
from obsengine.plans.lookup import lookup
from obsengine.sources import catalog

SCHEMA = "city string, date date, temp_max double, temp_min double, precipitation double, windspeed_max double"


@pytest.fixture(scope="module")
def database(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("published"))
    days = spark.createDataFrame(
        [
            (city, date(year, month, day), 36.0 + month, 1.0, 60.0, 2.0)
            for city in ("a", "b'c")
            for year in (2022, 2023)
            for month in (1, 2, 3)
            for day in (1, 2, 4)
        ],
        SCHEMA,
    )
    catalog.ensure_database(spark, "weather", f"{root}/db")
    catalog.ensure_database(spark, "weather", f"{root}/db")
    for build in (marts.city_temperature_stats, marts.monthly_patterns, marts.extreme_events):
        catalog.publish(spark, build(days), "weather", build.__name__, f"{root}/{build.__name__}")
    catalog.create_weather_summary(spark, "weather")
    return "weather"


def test_register_is_repeatable(spark, database, tmp_path):
    table = catalog.register_table(spark, database, "city_temperature_stats", str(tmp_path))
    assert table.count() == 12  # the location registered first stays


def test_publishing_again_serves_the_last_rows(spark, tmp_path):
    catalog.ensure_database(spark, "again", f"{tmp_path}/db")
    rows = spark.range(9).selectExpr("cast(id as string) AS data")
    for n, where in ((5, "a"), (3, "a"), (9, "b"), (2, "a")):
        catalog.publish(spark, rows.limit(n), "again", "other", f"{tmp_path}/{where}")
        assert spark.table("again.other").count() == n


def test_unknown_tables_have_one_text_column(spark, database, tmp_path):
    spark.createDataFrame([("x",)], "data string").write.parquet(f"{tmp_path}/o'ther")
    table = catalog.register_table(spark, database, "other", f"{tmp_path}/o'ther")
    assert table.dtypes == [("data", "string")] and table.first().data == "x"
    with pytest.raises(ValueError):
        catalog.register_table(spark, database, "bad", str(tmp_path), "parquet; x")


def test_summary_view_follows_its_table(spark, database):
    view = catalog.create_weather_summary(spark, database)
    assert {r.year for r in view.collect()} == {2023} and view.count() == 6
    stats = spark.table(f"{database}.city_temperature_stats")
    assert view.collect() == marts.weather_summary(stats).collect()
    assert catalog.create_weather_summary(spark, database, 2000).count() == 12
    assert catalog.create_weather_summary(spark, database).count() == 6


def test_lookups(spark, database):
    def count(*args):
        return lookup(spark, database, *args).count()

    assert count("cities") == 12 and count("cities", "b'c") == 6 and count("cities", "x") == 0
    assert count("cities", "a", date(2022, 2, 15), date(2023, 1, 1)) == 3
    assert count("monthly", "a") == 3
    assert count("summary", "a", None, date(2023, 2, 1)) == 2
    assert count("extreme-events", "a", date(2022, 1, 4), date(2022, 2, 1)) == 4
    assert lookup(spark, database, "precipitation", "a").columns == [
        "city", "year", "month", "total_precipitation", "days_with_rain",
    ]
    with pytest.raises(ValueError, match="unknown dataset"):
        count("health")
    with pytest.raises(ValueError, match="no period"):
        count("monthly", "a", date(2022, 1, 1))


def test_lookup_filters_reach_the_files(spark, database, plan):
    text = plan(lookup(spark, database, "cities", "a", date(2022, 2, 1), date(2023, 1, 31)))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "EqualTo(city,a)" in pushed and "GreaterThan(year,2022)" in pushed
