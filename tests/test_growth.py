"""Late rows, broken records, versions, profiles that grow, folded models and exact quartiles."""

import json
from datetime import date
from functools import partial
from pathlib import Path

import pytest
from conftest import multiset
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import functions as F

from obsengine import schemas
from obsengine.operators import aggregates, models, quartiles, splits
from obsengine.session import materialize
from obsengine.plans import ml
from obsengine.plans.lookup import lookup
from obsengine.sources import catalog, deltas, profiles, readers, writers

# Raw records


def raw(city, day, **more):
    values = dict.fromkeys(("latitude", "longitude", *readers.MEASURES), 1.5)
    return {"city": city, "date": f"2024-01-{day:02}", "extraction_timestamp": "2024-02-01T00:00:00", **values, **more}


def test_one_broken_element_costs_itself(spark, tmp_path):
    good = [raw("a", 1), raw("b},{", 2, temp_max=3), raw("c", 3, temp_min=None)]
    (tmp_path / "whole.json").write_text(json.dumps(good, indent=2))
    texts = [json.dumps(r) for r in (raw("d", 4), raw("e", 5), raw("f", 6, temp_max="hot"), raw("g", 7))]
    texts[1] = texts[1][:-1]
    (tmp_path / "broken.json").write_text("[\n" + " ,\n".join([*texts, "{oops}", "17", "null"]) + "]\n")
    (tmp_path / "single.json").write_text(json.dumps(raw("h", 8)))
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "none.json").write_text("[]")
    rows = readers.read_observations(spark, str(tmp_path)).collect()
    assert sorted(r.city for r in rows) == ["a", "b},{", "c", "d", "g", "h"]
    by_city = {r.city: r for r in rows}
    assert by_city["b},{"].temp_max == 3.0 and by_city["c"].temp_min is None
    assert by_city["a"].date == date(2024, 1, 1)
    bad = readers.quarantined_observations(spark, str(tmp_path)).collect()
    assert {Path(r.file).name for r in bad} == {"broken.json"}
    assert any(texts[1] == r.record for r in bad) and any("hot" in r.record for r in bad)
    assert {"{oops}"} <= {r.record for r in bad} and "".join(r.record for r in bad).count("17") == 1


def test_broken_lines_cost_themselves(spark, tmp_path):
    lines = [json.dumps(raw("a", 1)), "", "  ", "{", json.dumps(raw("b", 2, temp_max=[1])), json.dumps(raw("c", 3)), "[]"]
    (tmp_path / "x.json").write_text("\n".join(lines))
    rows = readers.read_observations(spark, str(tmp_path), multi_line=False).collect()
    assert sorted(r.city for r in rows) == ["a", "c"]
    bad = readers.quarantined_observations(spark, str(tmp_path), multi_line=False).collect()
    assert sorted(r.record for r in bad) == sorted([lines[3], lines[4], lines[6]])


# Late rows


def trusted(spark, *rows):
    """Trusted rows of (place, day, station, highest temperature)."""
    df = spark.createDataFrame(list(rows), "weather_city string, date date, station_name string, temp_max double")
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.TRUSTED.fields if f.name not in df.columns]
    return df.select("*", *rest).select(*schemas.TRUSTED.names)


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_late_rows_replace_their_place_and_day_only(spark, tmp_path):
    path, days = str(tmp_path / "trusted"), [date(2024, 1, n) for n in (1, 2, 3, 4)]
    first = [(c, d, s, 1.0) for c in ("a", "b", None) for d in (*days[:3], None) for s in ("x", "y")]
    writers.write_trusted(trusted(spark, *first), path)
    before = files(path)
    late = [("a", days[1], "x", 2.0), (None, days[1], "z", 2.0), ("c", days[3], "x", 2.0), ("a", None, "z", 2.0)]
    writers.merge_trusted(trusted(spark, *late), path)
    expected = [r for r in first if r[:2] != ("a", days[1])] + late
    names = ("weather_city", "date", "station_name", "temp_max")
    assert multiset(readers.read_trusted(spark, path).select(*names)) == multiset(trusted(spark, *expected).select(*names))
    after = files(path)
    untouched = [f for f in before if "2024-01-01" in f or "2024-01-03" in f]
    assert len(untouched) >= 2 and all(after.get(f) == before[f] for f in untouched)
    writers.merge_trusted(trusted(spark, *late).limit(0), path)
    assert files(path) == after


# Versions


def test_a_failed_write_leaves_the_published_rows(spark, tmp_path):
    catalog.ensure_database(spark, "versions", f"{tmp_path}/db")
    rows = spark.range(5).selectExpr("id AS n", "cast(id as string) AS label")
    publish = lambda df: catalog.publish(spark, df, "versions", "own", f"{tmp_path}/own")
    publish(rows)
    failing = rows.withColumn("n", F.when(F.col("n") == 4, F.raise_error(F.lit("halfway"))).otherwise(F.col("n")))
    with pytest.raises(Exception, match="halfway"):
        publish(failing)
    assert multiset(spark.table("versions.own")) == multiset(rows)


def test_versions_are_kept_until_they_are_dropped(spark, tmp_path):
    catalog.ensure_database(spark, "versions", f"{tmp_path}/db")
    rows = spark.range(9).selectExpr("id AS n")
    for n in (2, 4, 6, 9):
        catalog.publish(spark, rows.limit(n), "versions", "kept", f"{tmp_path}/kept")
        if n == 4:
            running = spark.table("versions.kept")
    assert running.count() == 4  # its files are still there
    (tmp_path / "kept" / "notes").mkdir()
    assert len(catalog.drop_versions(spark, "versions", "kept", keep=1)) == 2
    assert len(catalog.drop_versions(spark, "versions", "kept")) == 1
    assert spark.table("versions.kept").count() == 9
    assert len(list((tmp_path / "kept").iterdir())) == 2


def test_undeclared_tables_follow_the_columns_of_their_rows(spark, tmp_path):
    catalog.ensure_database(spark, "versions", f"{tmp_path}/db")
    for columns in ({"data": 1}, {"data": "x", "more": 2.5}):
        df = spark.createDataFrame([tuple(columns.values())], list(columns))
        assert catalog.publish(spark, df, "versions", "free", f"{tmp_path}/free").collect() == df.collect()


def row_groups_met(df):
    """Rows that the scan of a frame hands on, after row groups are skipped."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_lookup_skips_most_row_groups(spark, tmp_path):
    catalog.ensure_database(spark, "indexed", f"{tmp_path}/db")
    stats = spark.range(60_000).selectExpr(
        "concat('c', id % 100) AS city", "CAST(1400 + id DIV 1200 AS INT) AS year", "CAST(id DIV 100 % 12 + 1 AS INT) AS month",
        *(f"CAST(id AS {t}) AS {n}" for n, t in (("avg_temp_max", "DOUBLE"), ("avg_temp_min", "DOUBLE"), ("total_precipitation", "DOUBLE"),
          ("avg_windspeed", "DOUBLE"), ("days_with_rain", "INT"), ("extreme_temp_max", "DOUBLE"), ("extreme_temp_min", "DOUBLE"))),
    )
    catalog.publish(spark, stats, "indexed", "city_temperature_stats", f"{tmp_path}/stats", group_rows=200)
    found = lookup(spark, "indexed", "cities", "c42")
    assert found.count() == 600
    assert row_groups_met(found) < 6_000  # a tenth of all row groups
    few = lookup(spark, "indexed", "cities", "c42", date(1410, 1, 1), date(1411, 12, 31))
    assert few.count() == 24 and row_groups_met(few) <= 600
    assert lookup(spark, "indexed", "cities", "c42x").count() == 0
    assert row_groups_met(lookup(spark, "indexed", "cities", "c42x")) < 6_000


# Deltas


def test_tables_are_rebuilt_from_their_deltas(spark, tmp_path):
    schema = "k string, n int, `a.b` string, v double"
    versions = {
        "1": [("a", 1, None, 1.0), ("b", 1, "", 2.0), (None, 1, "x", 3.0), ("c", None, "x", 0.0)],
        "2": [("a", 1, "", 1.0), ("b", 1, "", 2.0), (None, 1, "x", 4.0)],
        "3": [],
        "4": [("c", None, "x", 0.0), ("b", 1, None, 2.0)],
    }
    previous, counted = None, {}
    for stamp, rows in versions.items():
        df = spark.createDataFrame(rows, schema)
        counted[stamp] = deltas.write_delta(df, str(tmp_path), "t", ["k", "n"], stamp, previous)
        previous = stamp
    assert counted == {
        "1": {"put": 4, "gone": 0}, "2": {"put": 2, "gone": 1}, "3": {"put": 0, "gone": 3}, "4": {"put": 2, "gone": 0}
    }
    for stamp, rows in versions.items():
        found = deltas.read_at(spark, str(tmp_path), "t", stamp)
        assert found.columns == ["k", "n", "a.b", "v"]
        assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, rows))
    twice = spark.createDataFrame([("a", 1, "x", 1.0), ("a", 1, "y", 1.0)], schema)
    with pytest.raises(ValueError, match="share a key"):
        deltas.write_delta(twice, str(tmp_path), "t", ["k", "n"], "5", "4")


# Profiles that grow

POINTS = "city string, date date, temperature double, humidity double"


def test_profile_of_batches_equals_that_of_all_rows(spark, tmp_path):
    rows = [
        (None if n % 11 == 0 else f"c{n % 3}", date(2024, 1 + n % 2, 1 + n % 28), None if n % 7 == 0 else 1e6 + n % 13, n % 5 or None)
        for n in range(500)
    ]
    df = spark.createDataFrame([(c, d, t, None if h is None else float(h)) for c, d, t, h in rows], POINTS)
    for batch in range(4):
        part = df.filter(F.pmod(F.xxhash64("date", "temperature"), F.lit(4)) == batch)
        profiles.add_to_profile(part.drop("humidity") if batch == 2 else part, str(tmp_path / "p"), str(batch))
    stored = profiles.read_profile(spark, str(tmp_path / "p"))
    lacking = F.pmod(F.xxhash64("date", "temperature"), F.lit(4)) == 2
    whole = aggregates.monthly_profile(df.withColumn("humidity", F.when(~lacking, F.col("humidity"))))
    for table in (aggregates.summary_from_profile, aggregates.trends_from_profile, aggregates.extremes_from_profile,
                  aggregates.distribution_from_profile, aggregates.averages_from_profile):
        got, want = table(stored), table(whole)
        for a, b in zip(got.collect(), want.collect(), strict=True):
            assert a.asDict() == {k: pytest.approx(v, rel=1e-9) if isinstance(v, float) else v for k, v in b.asDict().items()}
    with pytest.raises(Exception, match="(?i)exists"):
        profiles.add_to_profile(df, str(tmp_path / "p"), "1")
    profiles.compact_profile(spark, str(tmp_path / "p"), str(tmp_path / "c"), "0")
    again = aggregates.summary_from_profile(profiles.read_profile(spark, str(tmp_path / "c"))).collect()
    assert [r.days_with_data for r in again] == [r.days_with_data for r in aggregates.summary_from_profile(whole).collect()]


# Quartiles


@pytest.mark.parametrize("limit", [3, 50, 10_000])
def test_quartiles_are_exact_whatever_the_rows(spark, limit):
    """One place holds half of the rows, others have ties, few values, no value or no name."""
    df = spark.range(4000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 'half' WHEN id % 7 = 0 THEN NULL WHEN id < 40 THEN concat('p', id) "
        "WHEN id % 5 = 0 THEN 'ties' WHEN id % 3 = 0 THEN 'none' ELSE 'wide' END AS city",
        "CASE WHEN id % 2 = 0 THEN (id * 7919) % 4001 / 7D WHEN id % 5 = 0 THEN CAST(id % 2 AS DOUBLE) "
        "WHEN id % 3 = 0 AND id >= 40 THEN NULL WHEN id % 31 = 0 THEN double('NaN') "
        "ELSE pow(-1, id) * exp((id * 31) % 997 / 10D) END AS humidity",
    )
    got = quartiles.exact_quartiles(df, limit=limit)
    parts = [F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY humidity)") for p in quartiles.SHARES]
    want = df.groupBy("city").agg(*(p.alias(n) for p, n in zip(parts, ("humidity_q1", "humidity_median", "humidity_q3"))))
    assert multiset(got.drop("avg_humidity")) == multiset(want)
    assert quartiles.exact_quartiles(df.limit(0), limit=limit).count() == 0


# Folded models


def test_folding_keeps_every_row(spark):
    df = spark.range(25_000).selectExpr("IF(id < 24000, 1, id) AS a", "IF(id % 2 = 0 OR id < 24000, NULL, 'x') AS b")
    folded = models.folded_rows(df, ("a", "b", "a"))
    assert folded.count() == 1001 and folded.agg(F.max("weight")).first()[0] == 24_000
    assert multiset(models.unfolded(folded)) == multiset(df)


def test_weighted_deviations_are_those_of_all_rows(spark):
    df = spark.range(900).selectExpr("1e9 + id % 7 AS a", "IF(id % 3 = 0, NULL, id % 2) * 1D AS b", "5D AS c")
    got = models.weighted_deviations(models.folded_rows(df, "abc"), list("abc"))
    want = df.agg(*(F.stddev(c).alias(c) for c in "abc")).first()
    assert got == {c: pytest.approx(want[c], rel=1e-9) for c in "abc"}
    scaled = models.with_scaled(models.folded_rows(df, "ac"), {"a": got["a"], "c": got["c"]}).first()
    assert scaled.scaled_features[1] == 0 and scaled.scaled_features[0] == pytest.approx(scaled.a / want["a"])
    one = models.weighted_deviations(models.folded_rows(df.limit(1), "a"), ["a"])
    assert one == {"a": None}


@pytest.fixture(scope="module")
def days(spark):
    """Days of two seasons, repeated by station, with a clear rule for rain and temperature."""
    return materialize(
        spark.range(1200).selectExpr(
            "concat('c', id % 3) AS city_name", "date_add(DATE'2020-01-01', CAST(id DIV 3 AS INT)) AS date",
            "cast(month(date_add(DATE'2020-01-01', CAST(id DIV 3 AS INT))) AS INT) AS month",
            "cast(dayofyear(date_add(DATE'2020-01-01', CAST(id DIV 3 AS INT))) AS INT) AS day_of_year",
            "(id * 37) % 30 + 0.5D AS temp_min", "(id * 37) % 30 + 10.5D AS temp_max", "10D AS temp_range",
            "(id * 37) % 30 + 5.5D AS temp_avg", "IF((id * 37) % 30 > 15, 9D, 1D) AS precipitation",
            "explode(sequence(1, 1 + CAST(id % 5 AS INT))) AS station",
        ),
        "days",
    )


def test_forests_of_folded_rows_beat_the_constant_guess(days):
    rows, quality = models.temperature_model(days, seed=3, trees=10, depth=6)
    _, held_out = splits.hash_split(days)
    assert rows.count() == held_out.count() > 0
    assert quality.first().r2 > 0.9
    _, quality = models.precipitation_model(days, seed=3, trees=10, depth=5)
    common = days.agg(F.avg((F.col("precipitation") > 5).cast("double"))).first()[0]
    assert quality.first().accuracy > max(common, 1 - common) + 0.2


def test_clusters_of_folded_rows_cost_no_more(days):
    rows, quality = models.weather_clusters(days, seed=5)
    assert quality.first().total_records == rows.count() == days.count()
    names = ["temp_avg", "temp_range", "precipitation"]
    vectors = VectorAssembler(inputCols=names, outputCol="raw").transform(days)
    scaled = StandardScaler(inputCol="raw", outputCol="scaled").fit(vectors).transform(vectors)
    plain = KMeans(k=4, featuresCol="scaled", seed=5).fit(scaled).summary.trainingCost
    centre = [F.avg(F.col("scaled_features")[i]) for i in range(3)]
    centres = rows.groupBy("cluster").agg(F.array(*centre).alias("centre"))
    squares = sum(F.pow(F.col("scaled_features")[i] - F.col("centre")[i], F.lit(2.0)) for i in range(3))
    assert rows.join(centres, "cluster").agg(F.sum(squares)).first()[0] <= plain * 1.01


# Forests of many folded rows


def station_days(spark, n):
    """Days of one place whose altitude differs in every row."""
    return spark.range(n).selectExpr(
        "'a' AS city_name", "date_add(DATE'2024-01-01', int(id % 60)) AS date", "id % 60 % 9 * 2.5D AS precipitation",
        "id * 0.001D AS altitude", "id % 60 % 7 * 1.0D AS temp_min", "id % 60 % 11 * 1.0D AS temp_max",
        "dayofyear(date_add(DATE'2024-01-01', int(id % 60))) AS day_of_year",
    )


def stored_tables(monkeypatch):
    """The intermediate tables of the models, by name, as they are stored."""
    found = {}

    def keep(df, name):
        found[name] = materialize(df, name)
        return found[name]

    monkeypatch.setattr(models, "materialize", keep)
    return found


def test_forests_of_many_rows_are_fitted_on_folded_bins(spark, monkeypatch):
    days = station_days(spark, 30_000)
    names = ("city_name", "date", "temp_max")
    plain = models.temperature_model(days, seed=1, trees=3, depth=4)
    monkeypatch.setattr(models, "BINNED_ABOVE", 10)
    tables = stored_tables(monkeypatch)
    binned = models.temperature_model(days, seed=1, trees=3, depth=4)
    assert multiset(binned.rows.select(*names)) == multiset(plain.rows.select(*names))
    train, _ = splits.hash_split(days)
    fitted = tables["temperature-rows-binned"]
    assert fitted.agg(F.sum("weight")).first()[0] == train.count()
    assert fitted.select("altitude").distinct().count() == models.BINS
    assert fitted.count() <= 60 * models.BINS < train.count() / 2
    assert binned.metrics.first().rmse <= 1.1 * plain.metrics.first().rmse
    again = models.temperature_model(days, seed=1, trees=3, depth=4)
    assert multiset(again.rows) == multiset(binned.rows)


def test_sides_are_asked_once_per_day_and_bins_scored_once(spark, monkeypatch):
    """The digest of a day and the score of a row's bins are made once, not once per row."""
    days = station_days(spark, 30_000)
    asked, real = spark.sparkContext.accumulator(0), models.in_training

    def counted(keys, **options):
        @F.udf("boolean")
        def seen(value):
            asked.add(1)
            return value

        return seen(real(keys, **options))

    monkeypatch.setattr(models, "in_training", counted)
    monkeypatch.setattr(models, "BINNED_ABOVE", 10)
    tables = stored_tables(monkeypatch)
    rows = models.temperature_model(days, seed=1, trees=3, depth=4).rows
    keys = days.select("city_name", "date").distinct().count()
    assert 0 < asked.value <= 2 * keys < 30_000 / 10
    _, test = splits.hash_split(days)
    assert rows.count() == test.count()
    assert tables["temperatures-kinds"].count() < test.count() / 2


def test_split_and_scores_of_null_keys(frame):
    rows = [("a", "x", 1.0), (None, "x", 2.0), ("a", None, 3.0), (None, None, None)]
    df = frame("city_name string, date string, v double", *rows).withColumn("weight", F.lit(1))
    dealt = models._with_sides(df, "odd", 42)
    assert multiset(dealt) == multiset(df.withColumn("_train", splits.in_training(models.ROW_KEYS)))
    known = df.selectExpr("v", "v + 1 AS more")
    assert multiset(models._looked_up(df, known, ["v"])) == multiset(df.withColumn("more", F.col("v") + 1))


def test_only_columns_of_many_values_are_sketched(spark, monkeypatch):
    df = spark.range(2000).selectExpr("id * 1.0D AS a", "id % 7 * 1.0D AS b")
    sketched, real = [], type(df).approxQuantile

    def noted(self, names, *options):
        sketched.extend(names)
        return real(self, names, *options)

    monkeypatch.setattr(type(df), "approxQuantile", noted)
    edges = models.bin_edges(df, ["b", "a"], bins=8)
    assert sketched == ["a"] and list(edges) == ["b", "a"]
    assert edges["b"] == [float(n) for n in range(7)] and len(edges["a"]) == 8


def test_bins_keep_few_values_apart_and_nulls(frame):
    nan = float("nan")
    df = frame("a double, b double, c double", *((float(n), float(n % 3), 5.0) for n in range(500)), (None, nan, 5.0))
    edges = models.bin_edges(df, ["a", "b", "c"], bins=4)
    assert edges["b"] == [0.0, 1.0, 2.0]
    assert edges["c"] == [5.0] and len(edges["a"]) == 4
    rows = models.with_bins(df, edges)
    assert rows.columns == ["a", "b", "c"]
    assert rows.filter("a IS NULL").count() == 1 and rows.filter("c = 5").count() == 501
    assert rows.groupBy("a").count().filter("a IS NOT NULL AND abs(count - 125) > 2").isEmpty()
    assert rows.filter("a IS NULL").first().b == len(edges["b"])
    none = df.limit(0)
    assert models.with_bins(none, models.bin_edges(none, ["a", "b"])).count() == 0


def test_scored_rows_are_stored_folded(spark, monkeypatch):
    one = station_days(spark, 600).withColumns({"temp_avg": F.col("temp_max") / 2, "temp_range": F.col("temp_max") + 1})
    days = one.withColumn("copy", F.explode(F.array_repeat(F.lit(0), 50))).drop("copy")
    tables = stored_tables(monkeypatch)
    rows, metrics = models.weather_clusters(days, seed=1)
    assert rows.count() == 30_000 == metrics.first().total_records
    assert tables["clusters"].count() <= 600
    rows, metrics = models.temperature_model(days, seed=1, trees=2, depth=3)
    assert metrics.first().predictions_count == rows.count() == tables["temperatures"].agg(F.sum("weight")).first()[0]
    assert tables["temperatures"].count() <= 600


def test_a_run_of_all_models_stores_no_more_than_they_read(spark, monkeypatch):
    days = station_days(spark, 600).withColumns({
        "temp_avg": F.col("temp_max") / 2, "temp_range": F.col("temp_max") + 1, "month": F.month("date"),
        "year": F.year("date"), "station_name": F.lit("a station"), "population": F.lit(1),
    })
    stored = {}
    monkeypatch.setattr(ml, "materialize", lambda df, name: stored.setdefault(name, materialize(df, name)))
    monkeypatch.setattr(models, "prepare_ml", lambda df: df)
    monkeypatch.setattr(models, "temperature_model", partial(models.temperature_model, trees=2, depth=2))
    monkeypatch.setattr(models, "precipitation_model", partial(models.precipitation_model, trees=2, depth=2))
    out = ml.ml_run(days, seed=1)
    assert set(stored) == {"model-input"}
    assert set(stored["model-input"].columns) <= set(models.INPUT_NAMES) and stored["model-input"].count() == 600
    counts = {r.model_type: r.predictions_count for r in out["summary"].collect()}
    _, test = splits.hash_split(days)
    assert counts["temperature_prediction"] == counts["precipitation_classification"] == test.count()
    assert out["weather_clusters"].count() == 600
