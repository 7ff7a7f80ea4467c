import math
from datetime import date

import pytest
from conftest import multiset
from pyspark.sql import functions as F

from obsengine import fixtures
from obsengine.operators import aggregates as agg
from obsengine.operators import rankings
from obsengine.plans.descriptive import descriptive_tables

SCHEMA = "city string, date date, temperature double, humidity double, pressure double, wind_speed double"


def rounded(df):
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return multiset(df.withColumns({name: F.round(name, 6) for name in doubles}))


@pytest.fixture(scope="module")
def points(spark, sf_dir):
    df = fixtures.view(spark, sf_dir, "obs_point")
    # Nulls in every column, and days at both ends of long months.
    return df.withColumns(
        {
            "temperature": F.nullif("temperature", F.lit(7.0)),
            "humidity": F.nullif("humidity", F.lit(50.0)),
            "date": F.nullif("date", F.lit(date(1996, 1, 31))),
            "city": F.nullif("city", F.lit("NATION_3")),
        }
    ).cache()


def direct_summary(df):
    return df.groupBy("city").agg(
        F.count(F.lit(1)).alias("total_observations"),
        F.avg("temperature").alias("avg_temperature"),
        F.min("temperature").alias("min_temperature"),
        F.max("temperature").alias("max_temperature"),
        F.stddev("temperature").alias("std_temperature"),
        F.avg("humidity").alias("avg_humidity"),
        F.avg("pressure").alias("avg_pressure"),
        F.avg("wind_speed").alias("avg_wind_speed"),
        F.count_distinct("date").alias("days_with_data"),
    )


def test_summary_equals_direct_aggregation(points):
    assert rounded(agg.summary_statistics(points)) == rounded(direct_summary(points))


def test_summary_spread_of_a_large_offset(spark):
    # Deviations are small against the values: sums of squares would lose them.
    df = spark.range(400).selectExpr(
        "'a' as city", "date_add(date'2024-01-01', cast(id as int)) as date",
        "1e8D + id % 7 as temperature",
    )
    got = agg.summary_statistics(df).first().std_temperature
    want = df.agg(F.stddev("temperature")).first()[0]
    assert math.isclose(got, want, rel_tol=1e-6)


def test_summary_edge_groups(frame):
    df = frame(
        SCHEMA,
        ("one", date(2024, 1, 31), 5.0, 1.0, 1.0, 1.0),
        ("nulls", None, None, None, None, None),
        ("days", date(2024, 1, 1), 1.0, 1.0, 1.0, 1.0),
        ("days", date(2024, 1, 31), 2.0, 1.0, 1.0, 1.0),
        ("days", date(2024, 1, 31), 3.0, 1.0, 1.0, 1.0),
        ("days", date(2025, 1, 31), 4.0, 1.0, 1.0, 1.0),
    )
    rows = {row.city: row for row in agg.summary_statistics(df).collect()}
    assert rows["one"].std_temperature is None and rows["one"].days_with_data == 1
    assert rows["nulls"].avg_temperature is None and rows["nulls"].days_with_data == 0
    assert rows["nulls"].total_observations == 1
    assert rows["days"].days_with_data == 3
    assert agg.summary_statistics(df.limit(0)).collect() == []


def test_missing_measures_are_skipped(frame):
    df = frame("place string, day date, t double", ("a", date(2024, 1, 1), 1.0))
    out = agg.summary_statistics(df, city="place", date="day", temperature="t")
    assert "avg_humidity" not in out.columns and out.first().avg_temperature == 1.0


def test_results_are_sorted(points):
    cities = [row.city for row in agg.summary_statistics(points).collect()]
    assert cities == sorted(cities, key=lambda c: (c is not None, c))
    months = [(r.city or "", r.year or 0, r.month or 0) for r in agg.monthly_trends(points).collect()]
    assert months == sorted(months)


def test_distribution_of_nulls(frame):
    df = frame("city string, temperature double", ("a", None), ("a", 30.0), ("a", 1.0))
    assert [tuple(r) for r in agg.temperature_distribution(df).collect()] == [
        ("a", "Frío", 1), ("a", "Muy Cálido", 2),
    ]


def test_tables_from_one_profile_equal_the_single_operators(points):
    tables = descriptive_tables(points)
    single = {
        "summary_statistics": direct_summary(points),
        "monthly_temperature_trends": agg.monthly_trends(points),
        "extreme_temperatures": agg.extreme_temperatures(points),
        "temperature_distribution": agg.temperature_distribution(points),
        "humidity_analysis": agg.humidity_analysis(points),
        "city_rankings": rankings.city_rankings(points),
    }
    assert list(tables) == list(single)
    for name, table in tables.items():
        assert rounded(table) == rounded(single[name]), name


def test_summary_plan_shuffles_partial_results_only(points, plan):
    text = plan(agg.summary_statistics(points)).split("Initial Plan")[0]
    # Distinct days need no regrouping of the rows by date.
    assert "date" not in "".join(l for l in text.splitlines() if "hashpartitioning" in l)


def brute_ranks(rows, column):
    ordered = sorted(rows, key=lambda r: (-r[column], r["city"]))
    return {row["city"]: i + 1 for i, row in enumerate(ordered)}


@pytest.mark.parametrize("limit", [rankings.SINGLE_TASK_ROWS, 0], ids=["one-task", "distributed"])
def test_rankings_with_ties(spark, limit):
    # A third of the places tie on both measures.
    averages = spark.range(0, 5000, 1, 6).selectExpr(
        "concat('c', id) as city",
        "if(id % 3 = 0, 20.0D, id % 97) as avg_temperature",
        "if(id % 3 = 0, 50.0D, id % 89) as avg_humidity",
    )
    rows = averages.collect()
    got = rankings.rank_averages(averages, limit).collect()
    temperature, humidity = brute_ranks(rows, "avg_temperature"), brute_ranks(rows, "avg_humidity")
    assert len(got) == len(rows)
    for row in got:
        assert row.temp_rank == temperature[row.city]
        assert row.humidity_rank == humidity[row.city]


@pytest.mark.parametrize("limit", [rankings.SINGLE_TASK_ROWS, 0], ids=["one-task", "distributed"])
def test_null_place_takes_its_rank_and_leaves(frame, limit):
    df = frame(
        "city string, temperature double, humidity double",
        ("a", 1.0, 1.0), (None, 5.0, 0.0), ("b", 9.0, 2.0), ("c", 9.0, None),
    )
    rows = rankings.city_rankings(df, limit).collect()
    assert sorted((r.city, r.temp_rank, r.humidity_rank) for r in rows) == [
        ("a", 4, 2), ("b", 1, 1), ("c", 2, 4),
    ]


def test_cluster_statistics(frame):
    df = frame(
        "label int, temp_avg double, temp_range double, precipitation double",
        (1, 1.0, 2.0, 3.0), (1, 3.0, 4.0, 5.0), (0, 1.0, 1.0, 1.0),
    )
    rows = [tuple(r) for r in agg.cluster_statistics(df, "label").collect()]
    assert rows == [(0, 1, 1.0, 1.0, 1.0), (1, 2, 2.0, 3.0, 4.0)]
