"""The whole pipeline through its commands."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from obsengine import fixtures
from obsengine.__main__ import main
from obsengine.plans.lookup import lookup
from obsengine.plans.reports import preview
from obsengine.sources import readers, writers


@pytest.fixture(scope="module")
def raw(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("raw"))
    observations = fixtures.view(spark, sf_dir, "obs_daily").withColumn(
        "date", F.col("date").cast("string")
    )
    for stamp in ("2024-01-01T00:00:00", "2024-01-02T00:00:00"):
        batch = observations.withColumn("extraction_timestamp", F.lit(stamp))
        writers.land_batch(batch, f"{root}/observations", stamp[:10])
    tables = {"cities": "cities", "stations": "stations", "weather_alerts": "alerts"}
    frames = {table: fixtures.view(spark, sf_dir, name) for table, name in tables.items()}
    for stamp in ("20240101", "20240102"):  # a second snapshot multiplies nothing
        writers.snapshot_tables(spark, frames, root, stamp)
    return root


def test_pipeline(spark, raw, tmp_path, capsys):
    def run(*argv):
        main(argv)
        return json.loads(capsys.readouterr().out.splitlines()[-1])

    trusted, out = f"{tmp_path}/trusted", f"{tmp_path}/refined"
    report = run(
        "etl", "--observations", f"{raw}/observations/*", "--lines", "--latest",
        "--exports", f"{raw}/database_exports", "--stamp", "20240101", "--output", trusted,
    )
    # The batches overlap entirely, and each day is kept once.
    assert (report["total_records"], report["valid_records"]) == (6954, 3244)
    manifest = run("descriptive", "--input", trusted, "--output", out)
    assert manifest["total_records_processed"] == 6954 and manifest["analyses_generated"] == 6
    assert manifest["skipped"] == ["humidity_analysis"]

    predictions = f"{tmp_path}/predictions"
    readers.read_trusted(spark, trusted).filter("city_name is not null").select(
        "city_name", "date", F.col("temp_max").alias("prediction")
    ).write.parquet(predictions)
    published = run(
        "publish", "--input", trusted, "--database", "pipeline", "--output", out,
        "--predictions", predictions,
    )
    assert len(published["tables"]) == 5
    city = spark.table("pipeline.ml_predictions").first().city
    found = lookup(spark, "pipeline", "ml-predictions", city, date(1996, 1, 1), date(1996, 12, 31))
    assert 0 < found.count() < spark.table("pipeline.ml_predictions").count()
    assert {r.city for r in found.select("city").distinct().collect()} == {city}
    assert lookup(spark, "pipeline", "summary").isEmpty()  # all data is older


def test_preview(spark):
    assert preview(spark.range(10)).count() == 3
