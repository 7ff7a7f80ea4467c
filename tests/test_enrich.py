import pytest
from conftest import multiset
from pyspark.sql import functions as F

from obsengine import fixtures, schemas
from obsengine.functions import columns as fn
from obsengine.operators import joins
from obsengine.operators.joins import BROADCAST_LIMIT
from obsengine.plans.enrich import CITY_BAND, STATION_BAND, enrich
from obsengine.sources.readers import read_trusted
from obsengine.sources.writers import write_trusted

INPUTS = ("obs_daily", "cities", "stations", "alerts")


def inputs(spark, sf_dir):
    return [fixtures.view(spark, sf_dir, name) for name in INPUTS]


def test_expected_counts(spark, sf_dir):
    df = enrich(*inputs(spark, sf_dir))
    counts = df.agg(
        F.count(F.lit(1)),
        F.count_if("alert_triggered"),
        F.count_if(F.col("data_quality_score") == 1),
        F.count_if(F.col("city_name").isNull()),
        F.count_if(F.col("station_name").isNull()),
        F.count_if(F.col("alert_city").isNull()),
    ).first()
    assert tuple(counts) == (6954, 3194, 3244, 502, 3208, 1043)
    assert df.columns == schemas.TRUSTED.fieldNames()
    assert [f.dataType for f in df.schema] == [f.dataType for f in schemas.TRUSTED]


def test_order_of_joins_does_not_matter(spark, sf_dir):
    observations, cities, stations, alerts = inputs(spark, sf_dir)
    facts = fn.conform(observations, fn.OBSERVATION_NAMES)
    one_by_one = facts
    for right, names, pairs in (
        (cities, fn.CITY_NAMES, CITY_BAND),
        (stations, fn.STATION_NAMES, STATION_BAND),
    ):
        one_by_one = one_by_one.join(
            fn.conform(right, names), joins.within_band(pairs, 0.1), "left"
        )
    one_by_one = one_by_one.join(
        fn.conform(alerts, fn.ALERT_NAMES), F.col("city_name") == F.col("alert_city"), "left"
    )
    expected = (
        one_by_one.transform(fn.with_temp_avg)
        .transform(fn.with_alert_triggered)
        .transform(fn.with_quality_score)
    )
    rows = multiset(expected)
    assert multiset(enrich(observations, cities, stations, alerts)) == rows
    assert multiset(enrich(observations, cities, stations, alerts, broadcast_limit=0)) == rows


def test_fan_out(spark):
    observations = spark.createDataFrame(
        [("a", 1.0, 1.0, None, 40.0, 10.0, 3.0, 1.0)],
        "city string, latitude double, longitude double, date date, temp_max double, "
        "temp_min double, precipitation double, windspeed_max double",
    )
    cities = spark.createDataFrame([("A", "d", 1.0, 1.05, 5)], schemas.CITIES)
    stations = spark.createDataFrame(
        [("s1", "A", 1.0, 1.0, 1.0, "on"), ("s2", "A", 1.05, 1.0, None, "off")], schemas.STATIONS
    )
    alerts = spark.createDataFrame(
        [("A", "temperatura", "high", 30.0, False), ("A", "lluvia", "low", 3.0, True)],
        schemas.ALERTS,
    )
    rows = enrich(observations, cities, stations, alerts).collect()
    assert len(rows) == 4
    assert sum(row.alert_triggered for row in rows) == 2


def test_facts_are_not_shuffled(spark, sf_dir, plan):
    text = plan(enrich(*inputs(spark, sf_dir)))
    assert "NestedLoop" not in text
    final = text.split("Initial Plan")[0]
    # The only shuffle is the aggregation that makes the daily test view.
    assert final.count("hashpartitioning") == 1


@pytest.mark.parametrize("limit", [BROADCAST_LIMIT, 0])
def test_rows_of_one_task_are_dealt_by_date_and_written_whole(spark, sf_dir, tmp_path, limit):
    one_task = [df.coalesce(1) for df in inputs(spark, sf_dir)]
    one_task[0] = one_task[0].filter("date < DATE'1997-03-01' OR date IS NULL")
    rows = enrich(*one_task, broadcast_limit=limit, by_date=True)
    by_task = rows.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()
    # Beyond the limit the rows are dealt when they are many, at run time.
    assert limit == 0 or len(by_task) > 1 and max(t.n for t in by_task) < sum(t.n for t in by_task) / 2
    write_trusted(rows, str(tmp_path / "t"), by_date=True)
    assert multiset(read_trusted(spark, str(tmp_path / "t"))) == multiset(rows)
    assert all(len(list(day.glob("*.parquet"))) <= 2 for day in (tmp_path / "t").glob("date=*"))


def test_rows_dealt_by_date_are_written_without_another_shuffle(spark, sf_dir, plan):
    text = plan(enrich(*inputs(spark, sf_dir), by_date=True))
    final = text.split("Initial Plan")[0]
    assert final.count("rangepartitioning(date") == 1 and "hashpartitioning" not in final
