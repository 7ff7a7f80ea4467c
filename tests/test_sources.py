import json
from datetime import date, datetime
from pathlib import Path

import pytest
from conftest import multiset
from pyspark.sql import functions as F

from obsengine import schemas
from obsengine.sources import jdbc, readers, writers

RECORD = {
    "city": "a", "latitude": 1.5, "longitude": 2, "date": "2024-01-31", "temp_max": 30,
    "temp_min": 0, "precipitation": 0, "windspeed_max": 7, "extraction_timestamp": "2024-02-01T03:04:05.000006",
}


def files(path, suffix):
    return sorted(p for p in Path(path).rglob(f"*{suffix}"))


def test_pretty_printed_arrays_of_whole_numbers(spark, tmp_path):
    (tmp_path / "x_1.json").write_text(json.dumps([RECORD, {**RECORD, "date": "soon"}], indent=2))
    (tmp_path / "x_2.json").write_text(json.dumps([{**RECORD, "temp_max": 30.5}], indent=2))
    df = readers.read_observations(spark, f"{tmp_path}/*.json")
    assert dict(df.dtypes)["temp_max"] == "double" and dict(df.dtypes)["date"] == "date"
    rows = df.orderBy("temp_max", F.desc("date")).collect()
    assert [(r.date, r.temp_max) for r in rows] == [
        (date(2024, 1, 31), 30.0), (None, 30.0), (date(2024, 1, 31), 30.5),
    ]
    assert rows[0].extraction_timestamp == datetime(2024, 2, 1, 3, 4, 5, 6)


def test_landed_batches_read_back(spark, tmp_path):
    df = spark.createDataFrame([RECORD | {"longitude": 2.0, "temp_max": 30.0, "temp_min": 0.0, "precipitation": 0.0, "windspeed_max": 7.0}], schemas.RAW_OBSERVATION)
    for batch in ("1", "2"):
        path = writers.land_batch(df, str(tmp_path), batch)
        assert path.endswith(f"batch={batch}")
    assert readers.read_observations(spark, f"{tmp_path}/*", multi_line=False).count() == 2
    with pytest.raises(Exception, match="(?i)exists"):
        writers.land_batch(df, str(tmp_path), "1")


def test_latest_extraction_wins(spark):
    schema = "city string, date date, temp_max double, extraction_timestamp timestamp"
    day, later = date(2024, 1, 1), date(2024, 1, 2)
    df = spark.createDataFrame(
        [
            ("a", day, 1.0, datetime(2024, 2, 1)), ("a", day, 2.0, datetime(2024, 3, 1)),
            ("a", day, 1.5, datetime(2024, 3, 1)), ("a", later, 3.0, None),
            ("b", day, 4.0, datetime(2024, 1, 1)), ("b", day, 4.0, datetime(2024, 1, 1)),
        ],
        schema,
    )
    out = readers.latest_observations(df)
    assert out.columns == df.columns
    assert sorted((r.city, r.date, r.temp_max) for r in out.collect()) == [
        ("a", day, 2.0), ("a", later, 3.0), ("b", day, 4.0),
    ]


def payload(**daily):
    return {"city": "a", "latitude": 1.0, "longitude": 2.0, "extraction_timestamp": "2024-01-05", "daily": daily}


def test_payload_unpivot(spark, tmp_path):
    full = payload(
        time=["2024-01-01", "2024-01-02"], temperature_2m_max=[30, None], temperature_2m_min=[1.5, 2],
        precipitation_sum=[None, 0.5], windspeed_10m_max=[9],
    )
    (tmp_path / "p.json").write_text(json.dumps([full, payload(time=[])], indent=1))
    df = readers.read_payloads(spark, str(tmp_path))
    filled = readers.unpivot_daily_payload(df).orderBy("date").collect()
    assert [(r.temp_max, r.temp_min, r.precipitation, r.windspeed_max) for r in filled] == [
        (30.0, 1.5, 0.0, 9.0), (0.0, 2.0, 0.5, 0.0),
    ]
    assert filled[0].date == date(2024, 1, 1)
    kept = readers.unpivot_daily_payload(df, impute_zero=False).orderBy("date").collect()
    assert [(r.temp_max, r.windspeed_max) for r in kept] == [(30.0, 9.0), (None, None)]


def test_non_empty(spark, tmp_path):
    spark.range(0).write.parquet(f"{tmp_path}/none")
    spark.range(1).write.parquet(f"{tmp_path}/some")
    with pytest.raises(ValueError, match="no observations"):
        readers.read_non_empty(spark, f"{tmp_path}/none")
    assert readers.read_non_empty(spark, f"{tmp_path}/some").count() == 1


def trusted(spark, *days):
    rows = spark.createDataFrame([(d, float(i)) for i, d in enumerate(days)], "date date, lat double")
    return rows.select(
        *(
            F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schemas.TRUSTED.fields
        )
    )


def test_trusted_overwrite(spark, tmp_path, plan):
    path = f"{tmp_path}/t"
    one, two, three = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)
    writers.write_trusted(trusted(spark, one, one, two), path)
    assert sorted(p.name for p in Path(path).glob("date=*")) == ["date=2024-01-01", "date=2024-01-02"]
    df = readers.read_trusted(spark, path)
    assert df.columns[-1] == "date" and df.schema == schemas.TRUSTED
    assert df.groupBy("date").count().orderBy("date").collect() == [(one, 2), (two, 1)]
    writers.write_trusted(trusted(spark, two, two, three), path, replace_all=False)
    df = readers.read_trusted(spark, path)
    assert df.groupBy("date").count().orderBy("date").collect() == [(one, 2), (two, 2), (three, 1)]
    text = plan(df.filter(F.col("date") == two))
    assert "PartitionFilters: [isnotnull(date" in text
    writers.write_trusted(trusted(spark, three), path)
    assert readers.read_trusted(spark, path).count() == 1


def test_a_large_date_is_split_over_files(spark, tmp_path):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "50KB")
        df = spark.range(0, 60_000, 1, 8).selectExpr(
            "if(id % 3 = 0, date_add(date'2024-01-01', cast(id % 30 as int)), date'2023-01-01') as date",
            "xxhash64(id) as v",
        )
        writers.write_trusted(df, str(tmp_path / "t"))
    finally:
        spark.conf.set(key, before)
    assert len(files(tmp_path / "t" / "date=2023-01-01", ".parquet")) > 1


@pytest.mark.parametrize("single", [True, False])
def test_results_in_both_formats(spark, tmp_path, single):
    table = spark.range(0, 500, 1, 5).selectExpr("499 - id as id", "'x' as name").repartition(4)
    root = str(tmp_path)
    for _ in range(2):
        writers.save_results({"t": table}, root, {"t": ("id",)}, single)
    parquet = files(f"{root}/descriptive_analytics/t", ".snappy.parquet")
    csv = files(f"{root}/descriptive_analytics_csv/t", ".csv")
    assert multiset(spark.read.parquet(f"{root}/descriptive_analytics/t")) == multiset(table)
    lines = [line for path in csv for line in path.read_text().splitlines()]
    assert lines[0] == "id,name"
    if single:
        assert len(parquet) == len(csv) == 1
        assert lines[1:] == [f"{i},x" for i in range(500)]


def test_snapshot(spark, tmp_path):
    stamped = spark.createDataFrame(
        [(1, datetime(2024, 1, 2, 3, 4, 5), date(2024, 1, 2)), (2, datetime(2024, 1, 2, 3, 4, 5, 60), None)],
        "id int, at timestamp, day date",
    ).coalesce(1)
    manifest = writers.snapshot_tables(
        spark, {"stamped": stamped, "none": stamped.limit(0)}, str(tmp_path), "s"
    ).collect()
    assert [(r.table, r.records_count) for r in manifest] == [("stamped", 2)]
    (path,) = files(tmp_path, ".csv")
    assert path.read_text().splitlines() == [
        "id,at,day", "1,2024-01-02T03:04:05,2024-01-02", "2,2024-01-02T03:04:05.000060,",
    ]
    assert writers.snapshot_tables(spark, {}, str(tmp_path), "s").isEmpty()


def test_snapshot_text_comes_back(spark, tmp_path):
    texts = ["a\nb", 'q"u,o"te', "", None, "\\N", "\\\\x", " pad ", "cr\r\nlf", "plain"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id bigint, text string")
    writers.snapshot_tables(spark, {"docs": docs, "docs_old": docs}, str(tmp_path), "1")
    writers.snapshot_tables(spark, {"docs": docs.limit(2)}, str(tmp_path), "2")
    back = writers.read_snapshot(spark, f"{tmp_path}/database_exports", "docs", "1", docs.schema)
    assert multiset(back) == multiset(docs)


def test_rows_without_a_date_are_no_copies(spark):
    rows = [("a", None, 1.0, "1"), ("a", None, 2.0, "2"), ("a", "d", 1.0, "1"), ("a", "d", 2.0, "2")]
    df = spark.createDataFrame(rows, "city string, date string, v double, extraction_timestamp string")
    assert sorted(r.v for r in readers.latest_observations(df).collect()) == [1.0, 2.0, 2.0]


def test_jdbc_options():
    split = jdbc.Partitioning("id", 1, 1000, 8)
    options = jdbc.jdbc_options("jdbc:mysql://h/d", "cities", {"user": "u"}, split)
    assert options == {
        "url": "jdbc:mysql://h/d", "dbtable": "cities", "fetchsize": "10000", "useCursorFetch": "true",
        "user": "u", "partitionColumn": "id", "lowerBound": "1", "upperBound": "1000", "numPartitions": "8",
    }
    assert "useCursorFetch" not in jdbc.jdbc_options("jdbc:other:x", "t")
    environ = {"OBSENGINE_DB_USER": "u", "OBSENGINE_DB_PASSWORD": "p", "PATH": "x"}
    assert jdbc.connection_properties(environ=environ) == {"user": "u", "password": "p"}


def test_events_since(spark):
    events = spark.createDataFrame(
        [(1, 1, date(2022, 12, 31), "t", "s", "d"), (2, 1, date(2023, 1, 1), "t", "s", "d"), (3, 1, None, "t", "s", "d")],
        schemas.HISTORICAL_EVENTS,
    )
    assert [r.event_id for r in jdbc.events_since(events).collect()] == [2]
