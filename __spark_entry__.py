"""Registered queries over the test tables, and their SQL equivalents.

Aggregated doubles are rounded to six places on both sides, because engines
add them up in different orders. Where a value can round to zero from below,
the SQL adds 0: engines differ in the sign that such a zero keeps.
"""

from __future__ import annotations

import importlib
import importlib.util
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsengine import constants as C
from obsengine import fixtures, schemas
from obsengine.functions import columns as fn
from obsengine.operators import aggregates, joins, marts, metrics, models, quartiles, rankings, splits
from obsengine.plans import reports
from obsengine.plans.descriptive import descriptive_run, descriptive_tables
from obsengine.plans.enrich import CITY_BAND, STATION_BAND, enrich
from obsengine.plans.lookup import lookup
from obsengine.plans.ml import ml_run
from obsengine.session import scratch_path
from obsengine.sources import catalog, deltas, jdbc, profiles, readers, writers

SEED = 7
SUMMARY_FROM = 1998
LOOKUP_CITY = "NATION_18"
LOOKUP_START, LOOKUP_END = date(1997, 3, 1), date(2000, 8, 31)

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Enriched observations of the smallest test data."""
    return _enriched(spark, "/root/testdata/sf0.001")


# Inputs


def _view(name: str) -> Query:
    return lambda spark, sf_dir: fixtures.view(spark, sf_dir, name)


_obs_point, _obs_daily = _view("obs_point"), _view("obs_daily")
_cities, _stations, _alerts = _view("cities"), _view("stations"), _view("alerts")


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fn.conform(_obs_daily(spark, sf_dir), fn.OBSERVATION_NAMES)


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fn.conform(_cities(spark, sf_dir), fn.CITY_NAMES)


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fn.conform(_stations(spark, sf_dir), fn.STATION_NAMES)


def _rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fn.conform(_alerts(spark, sf_dir), fn.ALERT_NAMES)


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = (_obs_daily, _cities, _stations, _alerts)
    return enrich(*(read(spark, sf_dir) for read in inputs), by_date=True)


def _gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily observations with nulls in place of some values."""
    return _obs_daily(spark, sf_dir).withColumns(
        {
            "temp_max": F.nullif("temp_max", F.lit(50.0)),
            "precipitation": F.nullif("precipitation", F.lit(0.0)),
            "city_name": F.nullif("city", F.lit("NATION_8")),
        }
    )


def _rounded(df: DataFrame) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({name: F.round(name, 6) for name in doubles})


def _longs(df: DataFrame) -> DataFrame:
    ints = [f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegerType)]
    return df.withColumns({name: F.col(name).cast("long") for name in ints})


# Sources and sinks


def _scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.read_non_empty(spark, f"{sf_dir}/lineitem.parquet")
    return rows.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


def _as_raw(df: DataFrame, extracted: str) -> DataFrame:
    return df.select(
        "city",
        "latitude",
        "longitude",
        F.col("date").cast("string").alias("date"),
        *readers.MEASURES,
        F.lit(extracted).alias("extraction_timestamp"),
    )


def _raw_batch_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _as_raw(_obs_daily(spark, sf_dir), "2024-01-01T06:00:00")
    path = writers.land_batch(raw, scratch_path(spark, "raw"), "20240101_060000")
    return readers.read_observations(spark, path, multi_line=False).drop("extraction_timestamp")


def _latest_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = _obs_daily(spark, sf_dir)
    second = first.filter(F.month("date") <= 6).withColumn("temp_max", F.col("temp_max") + 1)
    batches = first.withColumn("extraction_timestamp", F.lit("2024-01-01").cast("timestamp")).union(
        second.withColumn("extraction_timestamp", F.lit("2024-02-01").cast("timestamp"))
    )
    return readers.latest_observations(batches).drop("extraction_timestamp")


def _payload_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.struct(F.col("date").cast("string").alias("date"), *readers.MEASURES)
    # One payload per place and year, as the requests are.
    payloads = (
        _gappy(spark, sf_dir)
        .groupBy("city", F.year("date"))
        .agg(
            F.any_value("latitude").alias("latitude"),
            F.any_value("longitude").alias("longitude"),
            F.collect_list(day).alias("d"),
        )
        .select(
            "city",
            "latitude",
            "longitude",
            F.lit("2024-01-01T06:00:00").alias("extraction_timestamp"),
            F.struct(
                F.col("d.date").alias("time"),
                F.col("d.temp_max").alias("temperature_2m_max"),
                F.col("d.temp_min").alias("temperature_2m_min"),
                F.col("d.precipitation").alias("precipitation_sum"),
                F.col("d.windspeed_max").alias("windspeed_10m_max"),
            ).alias("daily"),
        )
    )
    return readers.unpivot_daily_payload(payloads).drop("extraction_timestamp")


def _trusted_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "trusted")
    writers.write_trusted(_enriched(spark, sf_dir), path, by_date=True)
    return readers.read_trusted(spark, path)


def _snapshot_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("nation", "supplier", "orders")
    tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names}
    root = scratch_path(spark, "exports")
    return writers.snapshot_tables(spark, tables, root, "20240101_060000").drop("location")


def _historical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        F.col("user_id").alias("city_id"),
        F.col("ts").cast("date").alias("event_date"),
        "event_type",
        F.when(F.col("value") > 50, "high").otherwise("low").alias("severity"),
        F.col("props").alias("description"),
    )


def _undated_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping batches, the dates of dry days unreadable in the first."""
    raw = _as_raw(_obs_daily(spark, sf_dir), "2024-01-01T06:00:00")
    dry = F.col("precipitation") == 0
    first = raw.withColumn("date", F.when(dry, "no date").otherwise(F.col("date")))
    second = _as_raw(_obs_daily(spark, sf_dir).filter(~dry), "2024-01-02T06:00:00")
    root = scratch_path(spark, "raw")
    for stamp, batch in (("1", first), ("2", second)):
        writers.land_batch(batch, root, stamp)
    read = readers.read_observations(spark, f"{root}/*", multi_line=False)
    return readers.latest_observations(read).drop("extraction_timestamp")


def _odd_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks, quotes, backslashes, empty and null ones."""
    text, key = F.col("text"), F.col("doc_id")
    odd = (
        F.when(key % 7 == 0, F.lit(None)).when(key % 5 == 0, "")
        .when(key % 3 == 0, F.concat(F.lit("\\N"), text))
        .when(key % 2 == 0, F.concat(F.lit(' "a",'), text, F.lit(" ")))
        .otherwise(text)
    )
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", odd.alias("text"), "lang", "n_chars")


def _snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of one of two snapshots, read back."""
    root, odd = scratch_path(spark, "exports"), _odd_texts(spark, sf_dir)
    for stamp in ("20240101", "20240102"):
        writers.snapshot_tables(spark, {"docs": odd}, root, stamp)
    exports = f"{root}/database_exports"
    return writers.read_snapshot(spark, exports, "docs", "20240102", odd.schema)


def _snapshot_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table at two of three stamps, rebuilt from what changed between them."""
    root, key = scratch_path(spark, "deltas"), F.col("o_orderkey")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    raised = orders.withColumn("o_totalprice", F.when(key % 4 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    tables = {
        "20240101": orders.filter(key % 7 != 0),
        "20240102": raised.filter(key % 5 != 0),
        "20240103": orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("O"))),
    }
    previous = None
    for stamp, table in tables.items():
        deltas.write_delta(table, root, "orders", ["o_orderkey"], stamp, previous)
        previous = stamp
    at = [deltas.read_at(spark, root, "orders", s).withColumn("stamp", F.lit(s)) for s in ("20240102", "20240103")]
    return at[0].union(at[1])


def _sink(write: Callable[[DataFrame, str], None], read: Callable[[DataFrame, str], DataFrame]) -> Query:
    """Daily observations through a sink and back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows, path = _obs_daily(spark, sf_dir), scratch_path(spark, "sink")
        write(rows, path)
        return read(rows, path)

    return run


def _as_result(fmt: str) -> Query:
    folder = {"parquet": "descriptive_analytics", "csv": "descriptive_analytics_csv"}[fmt]
    return _sink(
        lambda df, path: writers.save_results({"days": df}, path, {"days": ("city", "date")}, single_file=False),
        lambda df, path: df.sparkSession.read.schema(df.schema)
        .option("header", True)
        .format(fmt)
        .load(f"{path}/{folder}/days"),
    )


def _late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations of some days that arrive late: corrected ones, and those of a place not stored yet."""
    late = _obs_daily(spark, sf_dir).filter((F.day("date") == 3) & (F.col("city") <= LOOKUP_CITY))
    return late.withColumn("temp_max", F.col("temp_max") + 1)


def _trusted_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trusted zone after late rows of some days and places were merged."""
    path, inputs = scratch_path(spark, "trusted"), (_cities, _stations, _alerts)
    places = [read(spark, sf_dir) for read in inputs]
    early = _obs_daily(spark, sf_dir).filter((F.day("date") != 3) | (F.col("city") != LOOKUP_CITY))
    writers.write_trusted(enrich(early, *places, by_date=True), path, by_date=True)
    writers.merge_trusted(enrich(_late_rows(spark, sf_dir), *places, by_date=True), path)
    return readers.read_trusted(spark, path)


def _broken_batches(spark: SparkSession, sf_dir: str) -> str:
    """Raw array files, one per place and year, some of whose records can't be read; returns their folder."""
    raw = _as_raw(_obs_daily(spark, sf_dir), "2024-01-01T06:00:00")
    text = F.to_json(F.struct(*raw.columns))
    cut = F.expr("substr(text, 1, length(text) - 1)")  # without its last brace
    wrong = F.regexp_replace("text", r'"temp_min":[^,]*', '"temp_min":"cold"')
    day = F.day(F.col("date").cast("date"))
    broken = F.when(day == 5, cut).when(day == 6, wrong).when(day == 7, F.lit("{no record}")).otherwise(F.col("text"))
    # One array per file: a place and year has a few hundred days.
    lists = (
        raw.withColumn("text", text).withColumn("text", broken)
        .groupBy(F.col("city").alias("place"), F.substr("date", F.lit(1), F.lit(4)).alias("year"))
        .agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("text"), ",\n"), F.lit("\n]\n")).alias("value"))
    )
    root = scratch_path(spark, "raw")
    lists.write.partitionBy("place", "year").text(root)
    return root


def _quarantined_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good rows, and the records that could not be read, by what is left of them."""
    root = f"{_broken_batches(spark, sf_dir)}/*/*"
    good = readers.read_observations(spark, root).select(
        "city", "date", "temp_min", F.lit(None).cast("string").alias("problem")
    )
    bad = readers.quarantined_observations(spark, root)
    part = lambda name: F.nullif(F.regexp_extract("record", f'"{name}":"([^"]*)"', 1), F.lit(""))
    problem = (
        F.when(F.col("record").contains('"cold"'), "type")
        .when(F.col("record").contains("no record"), "no object").otherwise("cut")
    )
    return good.union(
        bad.select(part("city"), part("date").cast("date"), F.lit(None).cast("double"), problem)
    )


# Published results


def _republished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table published twice at one location and then at another; its last rows."""
    root, database = scratch_path(spark, "published"), f"results_{uuid.uuid4().hex}"
    catalog.ensure_database(spark, database, f"{root}/database")
    name = "city_temperature_stats"
    rows = marts.city_temperature_stats(_obs_daily(spark, sf_dir))
    part = rows.filter(F.col("month") <= 6)
    for stage, where in ((part, "a"), (rows.limit(0), "a"), (rows, "b")):
        catalog.publish(spark, stage, database, name, f"{root}/{where}").count()
    return _rounded(spark.table(f"{database}.{name}"))


def _versioned_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last of three versions below one folder, the earlier ones dropped; also of an undeclared table."""
    root, database = scratch_path(spark, "published"), f"results_{uuid.uuid4().hex}"
    catalog.ensure_database(spark, database, f"{root}/database")
    rows = marts.city_temperature_stats(_obs_daily(spark, sf_dir))
    for stage in (rows.filter(F.col("month") <= 6), rows.limit(0), rows):
        catalog.publish(spark, stage, database, "city_temperature_stats", f"{root}/stats")
    dropped = len(catalog.drop_versions(spark, database, "city_temperature_stats"))
    rain = rows.groupBy("city").agg(F.sum("days_with_rain").alias("rainy"))
    for stage in (rain.select("city"), rain):  # the columns change
        catalog.publish(spark, stage, database, "rain", f"{root}/rain")
    stats = spark.table(f"{database}.city_temperature_stats")
    joined = stats.join(spark.table(f"{database}.rain"), "city")
    return _rounded(joined.withColumn("dropped", F.lit(dropped).cast("long")))


def _published(spark: SparkSession, sf_dir: str, *tables: str) -> str:
    """Register result tables of the daily observations in a fresh database."""
    build = {
        "city_temperature_stats": marts.city_temperature_stats,
        "monthly_patterns": marts.monthly_patterns,
        "extreme_events": marts.extreme_events,
    }
    root = scratch_path(spark, "published")
    database = f"results_{uuid.uuid4().hex}"
    catalog.ensure_database(spark, database, f"{root}/database")
    for name in tables:
        rows = build[name](_obs_daily(spark, sf_dir))
        catalog.publish(spark, rows, database, name, f"{root}/{name}")
    return database


def _summary_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _published(spark, sf_dir, "city_temperature_stats")
    return _rounded(catalog.create_weather_summary(spark, database, SUMMARY_FROM))


def _lookup(dataset: str, table: str, period: bool = True) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        database = _published(spark, sf_dir, table)
        if dataset == "summary":
            catalog.create_weather_summary(spark, database, SUMMARY_FROM)
        bounds = (LOOKUP_START, LOOKUP_END) if period else ()
        return _rounded(lookup(spark, database, dataset, LOOKUP_CITY, *bounds))

    return run


# Profiles


def _grown_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile of three batches that share months."""
    path, rows, day = scratch_path(spark, "profile"), _obs_point(spark, sf_dir), F.day("date")
    parts = {"1": day <= 9, "2": (day > 9) & (day <= 20), "3": day > 20}
    for batch, chosen in parts.items():
        profiles.add_to_profile(rows.filter(chosen), path, batch)
    return profiles.read_profile(spark, path)


# Models


def _model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.prepare_ml(_enriched(spark, sf_dir))


def _hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _facts(spark, sf_dir).withColumnRenamed("weather_city", "city_name")
    train, test = splits.hash_split(facts)
    parts = {"train": train, "test": test}
    named = [
        df.select("city_name", "date", F.lit(name).alias("part")) for name, df in parts.items()
    ]
    return named[0].union(named[1])


def _regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    guessed = _obs_daily(spark, sf_dir).withColumn("prediction", F.col("temp_min") * 0.5 + 35)
    return _rounded(metrics.regression_metrics(guessed))


def _classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    guessed = fn.with_precip_class(_obs_daily(spark, sf_dir)).withColumn(
        "prediction", F.when(F.col("temp_max") > 20, 1.0).otherwise(0.0)
    )
    return _rounded(metrics.classification_metrics(guessed))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _obs_daily(spark, sf_dir)
        .transform(fn.with_temp_avg)
        .transform(fn.with_temp_range)
        .withColumn("cluster", (F.month("date") % 4).cast("long"))
    )


def _folded_model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the temperature model fits and scores: distinct rows, their weights and sides."""
    rows = fn.fill_zero(_model_rows(spark, sf_dir), ("altitude", "population"))
    names = ("temp_min", "precipitation", "day_of_year", "altitude", "population", "temp_max", *models.ROW_KEYS)
    folded = models.folded_rows(rows, names)
    return _longs(folded.withColumn("training", splits.in_training(models.ROW_KEYS)))


def _weighted_scaling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deviations over the folded rows, which are those of all rows."""
    folded = models.folded_rows(_model_rows(spark, sf_dir), C.CLUSTER_FEATURES)
    spread = models.weighted_deviations(folded, C.CLUSTER_FEATURES)
    return _rounded(folded.agg(F.sum("weight").alias("n"), *(F.lit(v).alias(k) for k, v in spread.items())))


def _temperature_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.temperature_model(_model_rows(spark, sf_dir), SEED).rows


def _ml_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.ml_predictions(_temperature_predictions(spark, sf_dir), "forest-1")


def _precipitation_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.precipitation_model(_model_rows(spark, sf_dir), SEED).rows


def _weather_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.weather_clusters(_model_rows(spark, sf_dir), SEED).rows


def _fixed_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _obs_daily(spark, sf_dir).select(
        F.col("city").alias("city_name"), "date", "temp_max",
        (F.col("temp_min") * 0.5 + 35).alias("prediction"),
    )


def _prediction_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.ml_predictions(_fixed_predictions(spark, sf_dir), "fixed-1")


def _flagged(df: DataFrame) -> DataFrame:
    stamp = F.col("prediction_timestamp").isNotNull()
    return _rounded(df.withColumn("prediction_timestamp", stamp))


def _lookup_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, database = scratch_path(spark, "published"), f"results_{uuid.uuid4().hex}"
    catalog.ensure_database(spark, database, f"{root}/database")
    catalog.publish(spark, _prediction_table(spark, sf_dir), database, "ml_predictions", f"{root}/p")
    found = lookup(spark, database, "ml-predictions", LOOKUP_CITY, LOOKUP_START, LOOKUP_END)
    return _flagged(found)


def _fixed_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.ml_summary(
        {"a": _regression_metrics(spark, sf_dir), "b": _classification_metrics(spark, sf_dir)}
    )


def _scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("temp_max", "temp_min", "precipitation")
    scaled = models.scale_features(_obs_daily(spark, sf_dir), names)
    return _rounded(
        scaled.select(
            "city", "date",
            *(F.col("scaled_features")[i].alias(f"scaled_{name}") for i, name in enumerate(names)),
        )
    )


def _temperature_test_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    small = models.temperature_model(_model_rows(spark, sf_dir), SEED, trees=2, depth=3)
    return small.rows.select("city_name", "date", "temp_max")


def _precipitation_test_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    small = models.precipitation_model(_model_rows(spark, sf_dir), SEED, trees=2, depth=3)
    return small.rows.groupBy(F.col("precip_class").cast("long").alias("label")).agg(
        F.count("*").alias("n")
    )


# Registry


def _extra(what: str) -> dict:
    """Queries or SQL of the optional parts, as far as they are there.

    The pipeline needs the operators: without them it is left out too.
    """
    found: dict = {}
    try:
        if importlib.util.find_spec("obsengine.llm.queries") is None:
            return found
    except ModuleNotFoundError:
        return found
    for name in ("obsengine.llm.queries", "corpus_pipeline"):
        if importlib.util.find_spec(name) is not None:
            found |= getattr(importlib.import_module(name), what)
    return found


def queries() -> dict[str, Query]:
    """Every operator as ``(spark, sf_dir) -> DataFrame``."""

    def over(read: Query, *steps: Callable[[DataFrame], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = read(spark, sf_dir)
            for step in steps:
                df = df.transform(step)
            return df

        return run

    found = {
        # Sources and sinks
        "scan_parquet": _scan_parquet,
        "raw_batch_roundtrip": _raw_batch_roundtrip,
        "latest_observations": _latest_observations,
        "payload_unpivot": _payload_unpivot,
        "trusted_roundtrip": _trusted_roundtrip,
        "snapshot_tables": _snapshot_tables,
        "snapshot_rows": _snapshot_rows,
        "snapshot_delta": _snapshot_delta,
        "undated_observations": _undated_observations,
        "sink_parquet": _sink(
            writers.write_parquet, lambda df, path: df.sparkSession.read.parquet(path)
        ),
        "sink_json": _sink(
            writers.write_json, lambda df, path: df.sparkSession.read.schema(df.schema).json(path)
        ),
        "trusted_merge": _trusted_merge,
        "quarantined_observations": _quarantined_observations,
        "result_parquet": _as_result("parquet"),
        "result_csv": _as_result("csv"),
        "events_since": over(_historical, lambda df: jdbc.events_since(df, date(2024, 1, 10))),
        # Columns and filters
        "conform_observations": _facts,
        "derive_temps": over(
            _obs_daily,
            fn.with_temp_avg,
            fn.with_temp_range,
            lambda df: df.select("city", "date", "temp_avg", "temp_range"),
        ),
        "alert_triggered": lambda spark, sf_dir: fn.with_alert_triggered(
            joins.join_alerts(
                _obs_daily(spark, sf_dir).withColumnRenamed("city", "city_name"),
                _rules(spark, sf_dir),
            )
        ).select(
            "city_name", "date", "alert_type", "threshold_value", "is_active", "alert_triggered"
        ),
        "quality_score": over(
            _enriched,
            lambda df: df.select(
                "weather_city", "date", "city_name", "station_name", "data_quality_score"
            ),
        ),
        "calendar_features": over(
            _obs_daily,
            fn.with_calendar,
            lambda df: df.select("city", "date", "year", "month", "day_of_year"),
            _longs,
        ),
        "threshold_flags": over(
            _gappy,
            fn.with_flags,
            fn.with_precip_class,
            lambda df: df.select(
                "city", "date", "high_precipitation", "extreme_temp", "precip_class"
            ),
            _longs,
        ),
        "fill_zero": over(
            _gappy,
            lambda df: fn.fill_zero(df, readers.MEASURES),
            lambda df: df.select("city", "date", *readers.MEASURES),
        ),
        "complete_rows": over(_gappy, fn.complete_rows),
        # Joins
        "band_join_cities": lambda spark, sf_dir: joins.band_join(
            _facts(spark, sf_dir), _places(spark, sf_dir), CITY_BAND
        ),
        "band_join_stations": lambda spark, sf_dir: joins.band_join(
            _facts(spark, sf_dir), _sites(spark, sf_dir), STATION_BAND
        ),
        "join_alerts": lambda spark, sf_dir: joins.join_alerts(
            joins.band_join(_facts(spark, sf_dir), _places(spark, sf_dir), CITY_BAND),
            _rules(spark, sf_dir),
        ),
        "enrich_observations": _enriched,
        # Aggregates and rankings
        "summary_statistics": over(_obs_point, aggregates.summary_statistics, _rounded),
        "trusted_summary_statistics": over(
            _enriched,
            lambda df: aggregates.summary_statistics(
                df, city="city_name", temperature="temp_avg"
            ),
            _rounded,
        ),
        "monthly_temperature_trends": over(
            _obs_point, aggregates.monthly_trends, _rounded, _longs
        ),
        "extreme_temperatures": over(_obs_point, aggregates.extreme_temperatures, _rounded),
        "temperature_distribution": over(_obs_point, aggregates.temperature_distribution),
        "humidity_analysis": over(_obs_point, aggregates.humidity_analysis, _rounded),
        "city_rankings": over(_obs_point, rankings.city_rankings, _rounded),
        "pressure_quartiles": over(
            _obs_point,
            lambda df: aggregates.humidity_analysis(df, humidity="pressure"),
            _rounded,
        ),
        "exact_quartiles": over(
            _obs_point, lambda df: quartiles.exact_quartiles(df, humidity="pressure"), _rounded
        ),
        "incremental_profile": over(_grown_profile, aggregates.summary_from_profile, _rounded),
        "incremental_trends": over(_grown_profile, aggregates.trends_from_profile, _rounded, _longs),
        "trusted_city_rankings": over(
            _enriched,
            lambda df: descriptive_tables(df, city="city_name", temperature="temp_avg")[
                "city_rankings"
            ],
            _rounded,
        ),
        "cluster_statistics": over(_labelled, aggregates.cluster_statistics, _rounded),
        # Result tables, reports and lookups
        "city_temperature_stats": over(_obs_daily, marts.city_temperature_stats, _rounded),
        "monthly_patterns": over(_obs_daily, marts.monthly_patterns, _rounded),
        "extreme_events": over(_obs_daily, marts.extreme_events, _rounded),
        "weather_summary": _summary_view,
        "republished_stats": _republished,
        "versioned_publish": _versioned_publish,
        "quality_report": over(_enriched, reports.quality_report, _rounded),
        "execution_summary": over(
            _obs_point,
            lambda df: descriptive_run(df)["execution_summary"].drop("generated_at"),
        ),
        "lookup_cities": _lookup("cities", "city_temperature_stats"),
        "lookup_monthly": _lookup("monthly", "monthly_patterns", period=False),
        "lookup_extreme_events": _lookup("extreme-events", "extreme_events"),
        "lookup_precipitation": _lookup("precipitation", "city_temperature_stats"),
        "lookup_summary": _lookup("summary", "city_temperature_stats"),
        "lookup_ml_predictions": _lookup_predictions,
        # Models
        "prepare_ml": _model_rows,
        "hash_split": _hash_split,
        "regression_metrics": _regression_metrics,
        "classification_metrics": _classification_metrics,
        "scaled_features": _scaled_features,
        "folded_model_rows": _folded_model_rows,
        "weighted_scaling": _weighted_scaling,
        "temperature_test_rows": _temperature_test_rows,
        "precipitation_test_rows": _precipitation_test_rows,
        "prediction_error": over(
            _fixed_predictions,
            lambda df: fn.with_error(df, "temp_max").drop("prediction"),
            _rounded,
        ),
        "fixed_ml_predictions": over(_prediction_table, _flagged),
        "fixed_ml_summary": _fixed_summary,
        "temperature_predictions": _temperature_predictions,
        "precipitation_classes": _precipitation_classes,
        "weather_clusters": _weather_clusters,
        "weather_cluster_statistics": over(_weather_clusters, aggregates.cluster_statistics),
        "ml_summary": lambda spark, sf_dir: ml_run(_enriched(spark, sf_dir), SEED)["summary"],
        "ml_predictions": _ml_predictions,
    }
    return found | _extra("QUERIES")


# SQL equivalents

_FACTS = """facts AS (
  SELECT latitude AS lat, longitude AS lon, date, temp_max, temp_min, precipitation,
         windspeed_max, city AS weather_city FROM obs_daily)"""
_PLACES = """places AS (
  SELECT name AS city_name, department, latitude AS city_lat, longitude AS city_lon, population
  FROM cities)"""
_SITES = """sites AS (
  SELECT station_name, city AS station_city, latitude AS station_lat, longitude AS station_lon,
         altitude, status FROM stations)"""
_RULES = """rules AS (
  SELECT city AS alert_city, alert_type, severity, threshold_value, is_active FROM alerts)"""
_ENRICHED = f"""{_FACTS}, {_PLACES}, {_SITES}, {_RULES}, enriched AS (
  SELECT facts.*, places.*, sites.*, rules.*,
         (temp_max + temp_min) / 2 AS temp_avg,
         CASE WHEN alert_type = 'temperatura' AND temp_max > threshold_value THEN TRUE
              WHEN alert_type = 'lluvia' AND precipitation > threshold_value THEN TRUE
              ELSE FALSE END AS alert_triggered,
         CASE WHEN city_name IS NULL OR station_name IS NULL
              THEN CAST(0.5 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS data_quality_score
  FROM facts
  LEFT JOIN places ON abs(lat - city_lat) < 0.1 AND abs(lon - city_lon) < 0.1
  LEFT JOIN sites ON abs(lat - station_lat) < 0.1 AND abs(lon - station_lon) < 0.1
  LEFT JOIN rules ON city_name = alert_city)"""
_LATE = f"""FROM (
  SELECT * REPLACE (CASE WHEN day(date) = 3 AND city <= '{LOOKUP_CITY}' THEN temp_max + 1 ELSE temp_max END
                    AS temp_max) FROM obs_daily)"""
_GAPPY = """gappy AS (
  SELECT city, latitude, longitude, date, NULLIF(temp_max, 50) AS temp_max, temp_min,
         NULLIF(precipitation, 0) AS precipitation, windspeed_max,
         NULLIF(city, 'NATION_8') AS city_name FROM obs_daily)"""
_STATS = """stats AS (
  SELECT city, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         round(avg(temp_max), 6) AS avg_temp_max, round(avg(temp_min), 6) + 0 AS avg_temp_min,
         round(sum(precipitation), 6) AS total_precipitation,
         round(avg(windspeed_max), 6) AS avg_windspeed,
         CAST(count(*) FILTER (WHERE precipitation > 0) AS INTEGER) AS days_with_rain,
         round(max(temp_max), 6) AS extreme_temp_max, round(min(temp_min), 6) + 0 AS extreme_temp_min
  FROM obs_daily GROUP BY 1, 2, 3)"""
_PATTERNS = """patterns AS (
  SELECT m.city, m.month, round(avg_temperature, 6) AS avg_temperature,
         round(rain, 6) AS total_precipitation, precipitation_days,
         round(temperature_variance, 6) AS temperature_variance,
         CASE WHEN rain / days > usual THEN 'Wet' ELSE 'Dry' END AS seasonal_pattern
  FROM (SELECT city, CAST(month(date) AS INTEGER) AS month,
               avg((temp_max + temp_min) / 2) AS avg_temperature, sum(precipitation) AS rain,
               count(precipitation) AS days,
               CAST(count(*) FILTER (WHERE precipitation > 0) AS INTEGER) AS precipitation_days,
               var_samp((temp_max + temp_min) / 2) AS temperature_variance
        FROM obs_daily GROUP BY 1, 2) m
  JOIN (SELECT city, avg(precipitation) AS usual FROM obs_daily GROUP BY 1) c ON m.city = c.city)"""
_RUNS = """marked AS (
  SELECT city, date, temp_max, precipitation, windspeed_max,
         'heat' AS event_type, temp_max / 35 AS severity FROM obs_daily WHERE temp_max > 35
  UNION ALL
  SELECT city, date, temp_max, precipitation, windspeed_max,
         'heavy_rain', precipitation / 10 FROM obs_daily WHERE precipitation > 10),
numbered AS (
  SELECT *, CASE WHEN lag(date) OVER w = date - 1 THEN 0 ELSE 1 END AS starts FROM marked
  WINDOW w AS (PARTITION BY city, event_type ORDER BY date)),
runs AS (
  SELECT *, sum(starts) OVER (PARTITION BY city, event_type ORDER BY date) AS run FROM numbered),
happenings AS (
  SELECT city, min(date) AS event_date, event_type, round(max(temp_max), 6) AS temperature_max,
         round(max(precipitation), 6) AS precipitation,
         round(max(windspeed_max), 6) AS windspeed_max, round(max(severity), 6) AS severity_score,
         CAST(count(*) AS INTEGER) AS duration_days
  FROM runs GROUP BY city, event_type, run)"""
_SUMMARY = f"""summary AS (
  SELECT city, year, month, avg_temp_max, avg_temp_min, total_precipitation,
         CASE WHEN avg_temp_max > 30 THEN 'Hot' WHEN avg_temp_max < 15 THEN 'Cold'
              ELSE 'Moderate' END AS temperature_category,
         CASE WHEN total_precipitation > 200 THEN 'High'
              WHEN total_precipitation > 100 THEN 'Medium' ELSE 'Low' END AS precipitation_category
  FROM stats WHERE year >= {SUMMARY_FROM})"""
_AT_CITY = f"city = '{LOOKUP_CITY}'"
_IN_MONTHS = (
    f"make_date(year, month, 1) BETWEEN DATE '{LOOKUP_START.replace(day=1)}' "
    f"AND DATE '{LOOKUP_END.replace(day=1)}'"
)
_IN_PERIOD = (
    f"event_date <= DATE '{LOOKUP_END}' AND event_date + duration_days - 1 >= DATE '{LOOKUP_START}'"
)
_PREDICTED = """predicted AS (
  SELECT city, date AS prediction_date, round(temp_min * 0.5 + 35, 6) AS predicted_temp_max,
         CAST(NULL AS DOUBLE) AS predicted_temp_min, CAST(NULL AS DOUBLE) AS predicted_precipitation,
         CAST(NULL AS DOUBLE) AS confidence_score, 'fixed-1' AS model_version,
         TRUE AS prediction_timestamp FROM obs_daily)"""
_MODEL_ROWS = f"""WITH {_ENRICHED}, model_rows AS (
  SELECT *, CAST('0x' || substr(md5('42|' || city_name || '|' || date), 1, 15) AS BIGINT) % 10000
              >= 8000 AS held_out
  FROM enriched
  WHERE temp_max IS NOT NULL AND temp_min IS NOT NULL AND precipitation IS NOT NULL
    AND city_name IS NOT NULL)"""
_CATEGORY = """CASE WHEN temperature < 15 THEN 'Frío' WHEN temperature < 25 THEN 'Templado'
            WHEN temperature < 30 THEN 'Cálido' ELSE 'Muy Cálido' END"""

_REGRESSION = """WITH guessed AS (
  SELECT temp_max AS y, temp_max - (temp_min * 0.5 + 35) AS e FROM obs_daily)
SELECT round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae,
       round(1 - sum(e * e) / (var_pop(y) * count(*)), 6) AS r2, count(*) AS predictions_count
FROM guessed"""
_CLASSIFICATION = """WITH guessed AS (
  SELECT CASE WHEN precipitation > 5 THEN 1 ELSE 0 END AS y,
         CASE WHEN temp_max > 20 THEN 1 ELSE 0 END AS p FROM obs_daily),
classes AS (SELECT DISTINCT y AS c FROM guessed),
scored AS (
  SELECT c, count(*) FILTER (WHERE y = c) AS n, count(*) FILTER (WHERE p = c) AS guesses,
         count(*) FILTER (WHERE y = c AND p = c) AS hits
  FROM guessed, classes GROUP BY c)
SELECT round(sum(hits) / sum(n), 6) AS accuracy,
       round(sum(n * CASE WHEN guesses = 0 THEN 0 ELSE hits / guesses END) / sum(n), 6)
         AS "precision",
       round(sum(hits) / sum(n), 6) AS recall, CAST(sum(n) AS BIGINT) AS predictions_count
FROM scored"""

_SQL = {
    "scan_parquet": "SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem",
    "raw_batch_roundtrip": "SELECT * FROM obs_daily",
    "sink_parquet": "SELECT * FROM obs_daily",
    "sink_json": "SELECT * FROM obs_daily",
    "result_parquet": "SELECT * FROM obs_daily",
    "result_csv": "SELECT * FROM obs_daily",
    "undated_observations": """SELECT city, latitude, longitude,
       CASE WHEN precipitation = 0 THEN NULL ELSE date END AS date,
       temp_max, temp_min, precipitation, windspeed_max FROM obs_daily""",
    "snapshot_rows": """SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN ''
       WHEN doc_id % 3 = 0 THEN '\\N' || text WHEN doc_id % 2 = 0 THEN ' "a",' || text || ' '
       ELSE text END AS text, lang, n_chars FROM documents""",
    "snapshot_delta": """SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderstatus, '20240102' AS stamp FROM orders WHERE o_orderkey % 5 <> 0
UNION ALL
SELECT o_orderkey, o_custkey, o_totalprice, NULLIF(o_orderstatus, 'O'), '20240103' FROM orders""",
    "pressure_quartiles": """SELECT city, round(avg(pressure), 6) AS avg_humidity,
       round(quantile_disc(pressure, 0.25), 6) AS humidity_q1,
       round(quantile_disc(pressure, 0.5), 6) AS humidity_median,
       round(quantile_disc(pressure, 0.75), 6) AS humidity_q3
FROM obs_point GROUP BY city""",
    "trusted_city_rankings": f"""WITH {_ENRICHED}, means AS (
  SELECT city_name AS city, avg(temp_avg) AS t FROM enriched GROUP BY city_name),
ranked AS (
  SELECT city, round(t, 6) + 0 AS avg_temperature,
         row_number() OVER (ORDER BY t DESC, city NULLS FIRST) AS temp_rank,
         CAST(NULL AS DOUBLE) AS avg_humidity, CAST(NULL AS BIGINT) AS humidity_rank FROM means)
SELECT * FROM ranked WHERE city IS NOT NULL""",
    "republished_stats": f"WITH {_STATS} SELECT * FROM stats",
    "versioned_publish": f"""WITH {_STATS}
SELECT *, CAST(sum(days_with_rain) OVER (PARTITION BY city) AS BIGINT) AS rainy, CAST(2 AS BIGINT) AS dropped
FROM stats""",
    "trusted_merge": f"""WITH {_ENRICHED.replace("FROM obs_daily)", _LATE + ")", 1)} SELECT * FROM enriched""",
    "quarantined_observations": """SELECT CASE WHEN day(date) = 7 THEN NULL ELSE city END AS city,
       CASE WHEN day(date) = 7 THEN NULL ELSE date END AS date,
       CASE WHEN day(date) BETWEEN 5 AND 7 THEN NULL ELSE temp_min END AS temp_min,
       CASE day(date) WHEN 5 THEN 'cut' WHEN 6 THEN 'type' WHEN 7 THEN 'no object' END AS problem
FROM obs_daily""",
    "lookup_ml_predictions": f"""WITH {_PREDICTED} SELECT * FROM predicted WHERE {_AT_CITY}
  AND prediction_date BETWEEN DATE '{LOOKUP_START}' AND DATE '{LOOKUP_END}'""",
    "fixed_ml_predictions": f"WITH {_PREDICTED} SELECT * FROM predicted",
    "scaled_features": """SELECT city, date,
       round(temp_max / stddev_samp(temp_max) OVER (), 6) + 0 AS scaled_temp_max,
       round(temp_min / stddev_samp(temp_min) OVER (), 6) + 0 AS scaled_temp_min,
       round(precipitation / stddev_samp(precipitation) OVER (), 6) + 0 AS scaled_precipitation
FROM obs_daily""",
    "folded_model_rows": f"""{_MODEL_ROWS}
SELECT temp_min, precipitation, dayofyear(date) AS day_of_year, coalesce(altitude, 0) AS altitude,
       CAST(coalesce(population, 0) AS BIGINT) AS population, temp_max, city_name, date,
       count(*) AS weight, NOT held_out AS training
FROM model_rows GROUP BY ALL""",
    "weighted_scaling": f"""{_MODEL_ROWS}
SELECT count(*) AS n, round(stddev_samp((temp_max + temp_min) / 2), 6) AS temp_avg,
       round(stddev_samp(temp_max - temp_min), 6) AS temp_range,
       round(stddev_samp(precipitation), 6) AS precipitation FROM model_rows""",
    "temperature_test_rows": f"""{_MODEL_ROWS}
SELECT city_name, date, temp_max FROM model_rows WHERE held_out""",
    "precipitation_test_rows": f"""{_MODEL_ROWS}
SELECT CAST(CASE WHEN precipitation > 5 THEN 1 ELSE 0 END AS BIGINT) AS label, count(*) AS n
FROM model_rows WHERE held_out GROUP BY 1""",
    "prediction_error": """SELECT city AS city_name, date, round(temp_max, 6) AS temp_max,
       round(abs(temp_max - (temp_min * 0.5 + 35)), 6) AS error FROM obs_daily""",
    "latest_observations": """SELECT city, latitude, longitude, date,
       CASE WHEN month(date) <= 6 THEN temp_max + 1 ELSE temp_max END AS temp_max,
       temp_min, precipitation, windspeed_max FROM obs_daily""",
    "payload_unpivot": f"""WITH {_GAPPY}
SELECT city, latitude, longitude, date, coalesce(temp_max, 0) AS temp_max,
       temp_min, coalesce(precipitation, 0) AS precipitation, windspeed_max FROM gappy""",
    "trusted_roundtrip": f"WITH {_ENRICHED} SELECT * FROM enriched",
    "snapshot_tables": " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) AS records_count FROM {name}"
        for name in ("nation", "supplier", "orders")
    ),
    "events_since": """SELECT event_id, user_id AS city_id, CAST(ts AS DATE) AS event_date,
       event_type, CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS severity,
       props AS description
FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-10'""",
    "conform_observations": f"WITH {_FACTS} SELECT * FROM facts",
    "derive_temps": """SELECT city, date, (temp_max + temp_min) / 2 AS temp_avg,
       temp_max - temp_min AS temp_range FROM obs_daily""",
    "alert_triggered": f"""WITH {_RULES}
SELECT city AS city_name, date, alert_type, threshold_value, is_active,
       coalesce(alert_type = 'temperatura' AND temp_max > threshold_value
                OR alert_type = 'lluvia' AND precipitation > threshold_value,
                FALSE) AS alert_triggered
FROM obs_daily LEFT JOIN rules ON city = alert_city""",
    "quality_score": f"""WITH {_ENRICHED}
SELECT weather_city, date, city_name, station_name, data_quality_score FROM enriched""",
    "calendar_features": """SELECT city, date, year(date) AS year, month(date) AS month,
       dayofyear(date) AS day_of_year FROM obs_daily""",
    "threshold_flags": f"""WITH {_GAPPY}
SELECT city, date,
       CAST(CASE WHEN precipitation > 10 THEN 1 ELSE 0 END AS BIGINT) AS high_precipitation,
       CAST(CASE WHEN temp_max > 35 THEN 1 ELSE 0 END AS BIGINT) AS extreme_temp,
       CAST(CASE WHEN precipitation > 5 THEN 1 ELSE 0 END AS BIGINT) AS precip_class
FROM gappy""",
    "fill_zero": f"""WITH {_GAPPY}
SELECT city, date, coalesce(temp_max, 0) AS temp_max, temp_min,
       coalesce(precipitation, 0) AS precipitation, windspeed_max FROM gappy""",
    "complete_rows": f"""WITH {_GAPPY}
SELECT * FROM gappy WHERE temp_max IS NOT NULL AND temp_min IS NOT NULL
  AND precipitation IS NOT NULL AND city_name IS NOT NULL""",
    "band_join_cities": f"""WITH {_FACTS}, {_PLACES}
SELECT * FROM facts LEFT JOIN places
  ON abs(lat - city_lat) < 0.1 AND abs(lon - city_lon) < 0.1""",
    "band_join_stations": f"""WITH {_FACTS}, {_SITES}
SELECT * FROM facts LEFT JOIN sites
  ON abs(lat - station_lat) < 0.1 AND abs(lon - station_lon) < 0.1""",
    "join_alerts": f"""WITH {_FACTS}, {_PLACES}, {_RULES}
SELECT * FROM facts
LEFT JOIN places ON abs(lat - city_lat) < 0.1 AND abs(lon - city_lon) < 0.1
LEFT JOIN rules ON city_name = alert_city""",
    "enrich_observations": f"WITH {_ENRICHED} SELECT * FROM enriched",
    "summary_statistics": """SELECT city, count(*) AS total_observations,
       round(avg(temperature), 6) AS avg_temperature, round(min(temperature), 6) AS min_temperature,
       round(max(temperature), 6) AS max_temperature,
       round(stddev_samp(temperature), 6) AS std_temperature,
       round(avg(humidity), 6) AS avg_humidity, round(avg(pressure), 6) AS avg_pressure,
       round(avg(wind_speed), 6) AS avg_wind_speed, count(DISTINCT date) AS days_with_data
FROM obs_point GROUP BY city""",
    "trusted_summary_statistics": f"""WITH {_ENRICHED}
SELECT city_name AS city, count(*) AS total_observations,
       round(avg(temp_avg), 6) AS avg_temperature, round(min(temp_avg), 6) AS min_temperature,
       round(max(temp_avg), 6) AS max_temperature,
       round(stddev_samp(temp_avg), 6) AS std_temperature,
       count(DISTINCT date) AS days_with_data
FROM enriched GROUP BY city_name""",
    "monthly_temperature_trends": """SELECT city, year(date) AS year, month(date) AS month,
       round(avg(temperature), 6) AS avg_monthly_temp,
       round(min(temperature), 6) AS min_monthly_temp,
       round(max(temperature), 6) AS max_monthly_temp, count(*) AS observations_count
FROM obs_point GROUP BY 1, 2, 3""",
    "extreme_temperatures": """SELECT city, round(max(temperature), 6) AS highest_temp,
       round(min(temperature), 6) AS lowest_temp,
       round(max(temperature) - min(temperature), 6) AS temperature_range
FROM obs_point GROUP BY city""",
    "temperature_distribution": f"""SELECT city, {_CATEGORY} AS temp_category,
       count(*) AS days_count
FROM obs_point GROUP BY 1, 2""",
    "humidity_analysis": """SELECT city, round(avg(humidity), 6) AS avg_humidity,
       round(quantile_disc(humidity, 0.25), 6) AS humidity_q1,
       round(quantile_disc(humidity, 0.5), 6) AS humidity_median,
       round(quantile_disc(humidity, 0.75), 6) AS humidity_q3
FROM obs_point GROUP BY city""",
    "city_rankings": """WITH means AS (
  SELECT city, avg(temperature) AS t, avg(humidity) AS h FROM obs_point GROUP BY city)
SELECT city, round(t, 6) AS avg_temperature,
       row_number() OVER (ORDER BY t DESC, city) AS temp_rank, round(h, 6) AS avg_humidity,
       row_number() OVER (ORDER BY h DESC, city) AS humidity_rank
FROM means""",
    "cluster_statistics": """SELECT month(date) % 4 AS cluster, count(*) AS count,
       round(avg((temp_max + temp_min) / 2), 6) AS avg_temp,
       round(avg(temp_max - temp_min), 6) AS avg_temp_range,
       round(avg(precipitation), 6) AS avg_precipitation
FROM obs_daily GROUP BY 1""",
    "city_temperature_stats": f"WITH {_STATS} SELECT * FROM stats",
    "monthly_patterns": f"WITH {_PATTERNS} SELECT * FROM patterns",
    "extreme_events": f"WITH {_RUNS} SELECT * FROM happenings",
    "weather_summary": f"WITH {_STATS}, {_SUMMARY} SELECT * FROM summary",
    "quality_report": f"""WITH {_ENRICHED}
SELECT count(*) AS total_records, count(*) FILTER (WHERE data_quality_score = 1) AS valid_records,
       round(100 * (count(*) FILTER (WHERE data_quality_score = 1)) / count(*), 6) AS data_quality
FROM enriched""",
    "execution_summary": f"""SELECT 'summary_statistics' AS analysis_type,
       count(DISTINCT city) AS records_count, CAST(10 AS BIGINT) AS columns_count FROM obs_point
UNION ALL
SELECT 'monthly_temperature_trends', count(*), 7
FROM (SELECT DISTINCT city, year(date), month(date) FROM obs_point)
UNION ALL
SELECT 'extreme_temperatures', count(DISTINCT city), 4 FROM obs_point
UNION ALL
SELECT 'temperature_distribution', count(*), 3
FROM (SELECT DISTINCT city, {_CATEGORY} FROM obs_point)
UNION ALL
SELECT 'humidity_analysis', count(DISTINCT city), 5 FROM obs_point
UNION ALL
SELECT 'city_rankings', count(DISTINCT city), 5 FROM obs_point""",
    "lookup_cities": f"WITH {_STATS} SELECT * FROM stats WHERE {_AT_CITY} AND {_IN_MONTHS}",
    "lookup_monthly": f"WITH {_PATTERNS} SELECT * FROM patterns WHERE {_AT_CITY}",
    "lookup_extreme_events": f"""WITH {_RUNS}
SELECT * FROM happenings WHERE {_AT_CITY} AND {_IN_PERIOD}""",
    "lookup_precipitation": f"""WITH {_STATS}
SELECT city, year, month, total_precipitation, days_with_rain
FROM stats WHERE {_AT_CITY} AND {_IN_MONTHS}""",
    "lookup_summary": f"""WITH {_STATS}, {_SUMMARY}
SELECT * FROM summary WHERE {_AT_CITY} AND {_IN_MONTHS}""",
    "prepare_ml": f"""WITH {_ENRICHED}
SELECT *, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       CAST(dayofyear(date) AS INTEGER) AS day_of_year, temp_max - temp_min AS temp_range,
       CASE WHEN precipitation > 10 THEN 1 ELSE 0 END AS high_precipitation,
       CASE WHEN temp_max > 35 THEN 1 ELSE 0 END AS extreme_temp
FROM enriched
WHERE temp_max IS NOT NULL AND temp_min IS NOT NULL AND precipitation IS NOT NULL
  AND city_name IS NOT NULL""",
    "hash_split": """SELECT city AS city_name, date,
       CASE WHEN CAST('0x' || substr(md5('42|' || city || '|' || date), 1, 15) AS BIGINT) % 10000
                 < 8000 THEN 'train' ELSE 'test' END AS part
FROM obs_daily""",
    "regression_metrics": _REGRESSION,
    "classification_metrics": _CLASSIFICATION,
    "fixed_ml_summary": f"""SELECT 'a' AS model_type, rmse, mae, r2, CAST(NULL AS DOUBLE) AS accuracy,
       CAST(NULL AS DOUBLE) AS "precision", CAST(NULL AS DOUBLE) AS recall,
       CAST(predictions_count AS BIGINT) AS predictions_count, CAST(NULL AS BIGINT) AS clusters_count,
       CAST(NULL AS BIGINT) AS total_records FROM ({_REGRESSION}) x
UNION ALL
SELECT 'b', NULL, NULL, NULL, accuracy, "precision", recall, predictions_count, NULL, NULL
FROM ({_CLASSIFICATION}) y""",
}


_SQL["exact_quartiles"] = _SQL["pressure_quartiles"]
_SQL["incremental_profile"] = _SQL["summary_statistics"]
_SQL["incremental_trends"] = _SQL["monthly_temperature_trends"]


def oracle_sql() -> dict[str, str]:
    """SQL text per query; model outputs and other unstable results have none."""
    return {name: fixtures.with_views(query) for name, query in _SQL.items()} | _extra("SQL")
