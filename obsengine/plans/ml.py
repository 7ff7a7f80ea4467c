"""All models over trusted rows, their outputs and summary."""

from pyspark.sql import DataFrame

from obsengine.functions import columns as fn
from obsengine.operators import models
from obsengine.operators.aggregates import cluster_statistics
from obsengine.plans.reports import ml_summary
from obsengine.session import materialize
from obsengine.sources.writers import write_json, write_parquet


def ml_run(df: DataFrame, seed: int, root: str | None = None) -> dict[str, DataFrame]:
    """Train and score every model on trusted rows; written below ``root`` if given.

    Returns the scored rows, the cluster statistics and the summary.
    """
    # Read by three models, several times each: computed once, with no more than they read.
    ready = models.prepare_ml(df)
    ready = materialize(ready.select(*fn.available(ready, models.INPUT_NAMES)), "model-input")
    runs = {
        "temperature_prediction": models.temperature_model(ready, seed),
        "precipitation_classification": models.precipitation_model(ready, seed),
        "weather_clustering": models.weather_clusters(ready, seed),
    }
    # Scored rows are stored folded: copies are made only where they are written.
    outputs = {
        "temperature_predictions": runs["temperature_prediction"].rows,
        "precipitation_classification": runs["precipitation_classification"].rows,
        "weather_clusters": runs["weather_clustering"].rows,
        "cluster_statistics": cluster_statistics(runs["weather_clustering"].rows),
    }
    summary = ml_summary({name: run.metrics for name, run in runs.items()})
    if root is not None:
        base = f"{root.rstrip('/')}/ml_results"
        for name, rows in outputs.items():
            write_parquet(rows, f"{base}/{name}")
        write_json(summary, f"{base}/summary")
    return {**outputs, "summary": summary}
