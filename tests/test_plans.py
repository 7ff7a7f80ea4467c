from pathlib import Path

import pytest
from conftest import multiset
from pyspark.sql import functions as F

from obsengine import fixtures
from obsengine.plans import descriptive, reports
from obsengine.plans.etl import run_etl
from obsengine.session import scratch_root
from obsengine.sources import readers

NAMES = ("obs_daily", "cities", "stations", "alerts")


def test_etl_reports_what_it_wrote(spark, sf_dir, tmp_path):
    report = run_etl(*(fixtures.view(spark, sf_dir, n) for n in NAMES), str(tmp_path / "t"))
    assert report["total_records"] == 6954 and report["valid_records"] == 3244
    stored = readers.read_trusted(spark, str(tmp_path / "t"))
    direct = reports.quality_report(stored).first()
    assert tuple(direct) == (6954, 3244, pytest.approx(report["data_quality"]))


def test_etl_of_nothing(spark, sf_dir, tmp_path):
    inputs = [fixtures.view(spark, sf_dir, n) for n in NAMES]
    report = run_etl(inputs[0].limit(0), *inputs[1:], str(tmp_path / "t"))
    assert (report["total_records"], report["data_quality"]) == (0, None)


def test_quality_report_of_nothing(frame):
    df = frame("data_quality_score double", (1.0,)).limit(0)
    assert tuple(reports.quality_report(df).first()) == (0, 0, None)


def test_descriptive_run(spark, sf_dir, tmp_path):
    df = fixtures.view(spark, sf_dir, "obs_point")
    tables = descriptive.descriptive_run(df, str(tmp_path))
    assert list(tables) == [*descriptive.TABLE_ORDER, "execution_summary"]
    for row in tables["execution_summary"].collect():
        assert row.records_count == tables[row.analysis_type].count()
        assert row.columns_count == len(tables[row.analysis_type].columns)
        assert row.generated_at is not None
    for name, table in tables.items():
        if name != "execution_summary":
            saved = spark.read.parquet(f"{tmp_path}/descriptive_analytics/{name}")
            assert multiset(saved) == multiset(table)
    csv = list(Path(f"{tmp_path}/descriptive_analytics_csv/city_rankings").glob("*.csv"))
    places = tables["city_rankings"].count()
    assert len(csv) == 1 and len(csv[0].read_text().splitlines()) == 1 + places
    manifest = descriptive.manifest(tables, str(tmp_path))
    assert manifest.analyses_generated == 7 and manifest.total_records_processed == df.count()


def test_descriptive_tables_of_trusted_rows(spark, sf_dir, tmp_path):
    run_etl(*(fixtures.view(spark, sf_dir, n) for n in NAMES), str(tmp_path / "t"))
    trusted = readers.read_trusted(spark, str(tmp_path / "t"))
    tables = descriptive.descriptive_tables(trusted, city="city_name", temperature="temp_avg")
    assert "humidity_analysis" not in tables
    ranked = tables["city_rankings"].collect()
    assert ranked and all(r.humidity_rank is None and r.temp_rank for r in ranked)
    stats = tables["summary_statistics"]
    assert stats.agg(F.sum("total_observations")).first()[0] == trusted.count()


def test_scratch_root_is_the_sessions(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
