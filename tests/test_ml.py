import pytest
from conftest import multiset
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import Observation
from pyspark.sql import functions as F

from obsengine import fixtures
from obsengine.operators import metrics, models, splits
from obsengine.operators.aggregates import cluster_statistics
from obsengine.plans.enrich import enrich
from obsengine.plans.ml import ml_run
from obsengine.session import materialize

SMALL = {"trees": 5, "depth": 4}


@pytest.fixture(scope="module")
def trusted(spark, sf_dir):
    names = ("obs_daily", "cities", "stations", "alerts")
    return materialize(enrich(*(fixtures.view(spark, sf_dir, n) for n in names)), "trusted")


@pytest.fixture(scope="module")
def ready(trusted):
    return models.prepare_ml(trusted)


def test_prepare_keeps_complete_rows(trusted, ready):
    assert ready.count() == trusted.filter("city_name is not null").count()


def test_split_is_a_function_of_the_keys(ready):
    train, test = splits.hash_split(ready)
    share = train.count() / ready.count()
    assert 0.75 < share < 0.85 and train.count() + test.count() == ready.count()
    keys = ["city_name", "date"]
    assert train.select(keys).intersect(test.select(keys)).isEmpty()
    again, _ = splits.hash_split(ready.repartition(13))
    assert multiset(again.select(keys)) == multiset(train.select(keys))
    other, _ = splits.hash_split(ready, seed=43)
    assert multiset(other.select(keys)) != multiset(train.select(keys))
    with pytest.raises(ValueError):
        splits.in_training(keys, share=2)


def test_split_keeps_rows_of_null_keys(frame):
    df = frame("city_name string, date string", (None, None), ("a", None), (None, "b"))
    train, test = splits.hash_split(df)
    assert train.count() + test.count() == 3


def test_regression_metrics_match_the_evaluator(spark):
    df = spark.range(500).selectExpr("id % 17 + rand(1) as temp_max", "id % 19 * 1.0D as prediction")
    got = metrics.regression_metrics(df).first()
    evaluator = RegressionEvaluator(labelCol="temp_max")
    for name in ("rmse", "mae", "r2"):
        want = evaluator.evaluate(df, {evaluator.metricName: name})
        assert got[name] == pytest.approx(want, rel=1e-9)
    assert got.predictions_count == 500


def test_classification_metrics_match_the_evaluator(spark):
    # Class 3 is never predicted, and class 4 is predicted but never occurs.
    df = spark.range(700).selectExpr(
        "cast(id % 4 as int) as precip_class", "if(id % 5 = 3, 4, id % 3) * 1.0D as prediction"
    )
    got = metrics.classification_metrics(df).first()
    evaluator = MulticlassClassificationEvaluator(labelCol="precip_class")
    for name, metric in {
        "accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall"
    }.items():
        want = evaluator.evaluate(df, {evaluator.metricName: metric})
        assert got[name] == pytest.approx(want, rel=1e-9)


def test_metrics_of_no_rows(frame):
    none = frame("temp_max double, precip_class int, prediction double", (1.0, 1, 1.0)).limit(0)
    assert tuple(metrics.regression_metrics(none).first()) == (None, None, None, 0)
    assert tuple(metrics.classification_metrics(none).first()) == (None, None, None, 0)


def test_temperature_model(ready):
    rows, quality = models.temperature_model(ready, seed=1, **SMALL)
    assert rows.columns == ["temp_max", "prediction", "city_name", "date", "error"]
    _, test = splits.hash_split(ready)
    assert rows.count() == test.count() == quality.first().predictions_count
    assert rows.filter("error < 0 or error is null").isEmpty()
    spread = ready.agg(F.stddev("temp_max")).first()[0]
    assert 0 < quality.first().rmse < spread


def test_models_repeat_with_the_same_seed(ready):
    first = models.temperature_model(ready, seed=1, **SMALL).rows
    second = models.temperature_model(ready, seed=1, **SMALL).rows
    assert multiset(first) == multiset(second)


def test_absent_features_are_left_out(ready):
    rows, _ = models.temperature_model(ready.drop("altitude", "population"), seed=1, **SMALL)
    assert rows.count() > 0


def test_precipitation_model_after_an_observed_write(spark, ready, tmp_path):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{tmp_path}/x")
    assert seen.get["n"] == 3
    rows, quality = models.precipitation_model(ready, seed=1, **SMALL)
    assert rows.columns == ["precip_class", "prediction", "probability"]
    first = rows.first()
    assert len(first.probability) == 2 and sum(first.probability) == pytest.approx(1)
    assert 0.5 < quality.first().accuracy <= 1


def test_clusters(ready):
    rows, quality = models.weather_clusters(ready, seed=1)
    assert tuple(quality.first()) == (4, ready.count())
    stats = cluster_statistics(rows).collect()
    assert [r.cluster for r in stats] == [0, 1, 2, 3]
    assert sum(r["count"] for r in stats) == ready.count()


def test_run_writes_everything(spark, trusted, tmp_path):
    out = ml_run(trusted, seed=1, root=str(tmp_path))
    summary = {r.model_type: r for r in spark.read.json(f"{tmp_path}/ml_results/summary").collect()}
    assert set(summary) == {
        "temperature_prediction", "precipitation_classification", "weather_clustering"
    }
    assert summary["weather_clustering"].clusters_count == 4
    assert out["summary"].filter("model_type = 'weather_clustering'").first().rmse is None
    for name in ("temperature_predictions", "precipitation_classification", "weather_clusters", "cluster_statistics"):
        assert spark.read.parquet(f"{tmp_path}/ml_results/{name}").count() == out[name].count()
