"""Reports over pipeline results."""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsengine import constants as C

# Metrics of any model, in the order of the summary.
SUMMARY_METRICS = {
    "rmse": "double",
    "mae": "double",
    "r2": "double",
    "accuracy": "double",
    "precision": "double",
    "recall": "double",
    "predictions_count": "long",
    "clusters_count": "long",
    "total_records": "long",
}


def quality_counts() -> list[Column]:
    """Total and valid rows, as aggregates that can also observe a write."""
    valid = F.col("data_quality_score") == C.SCORE_COMPLETE
    return [
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(valid).alias("valid_records"),
    ]


def quality_report(df: DataFrame) -> DataFrame:
    """Total rows, valid rows and percent valid; the percentage of no rows is null."""
    share = F.try_divide("valid_records", "total_records") * 100
    return df.agg(*quality_counts()).withColumn("data_quality", share)


def execution_summary(results: Mapping[str, DataFrame]) -> DataFrame:
    """One row per result table with its row and column counts, counted in one job."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("records_count")).select(
            F.lit(name).alias("analysis_type"),
            "records_count",
            F.lit(len(df.columns)).cast("long").alias("columns_count"),
        )
        for name, df in results.items()
    ]
    return reduce(DataFrame.union, counted).withColumn("generated_at", F.current_timestamp())


def ml_summary(metrics: Mapping[str, DataFrame]) -> DataFrame:
    """One row per model; metrics that a model does not have are null."""
    rows = [
        df.select(
            F.lit(model).alias("model_type"),
            *(
                (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)
                for name, kind in SUMMARY_METRICS.items()
            ),
        )
        for model, df in metrics.items()
    ]
    return reduce(DataFrame.union, rows)


def preview(df: DataFrame, rows: int = 3) -> DataFrame:
    """Any few rows of ``df``, for a look at them."""
    return df.limit(rows)
