"""Model metrics as one-row DataFrames, each from a single aggregation."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(
    predictions: DataFrame, label: str = "temp_max", prediction: str = "prediction"
) -> DataFrame:
    """``rmse``, ``mae``, ``r2`` and ``predictions_count`` of rows with both values."""
    actual, error = F.col(label), F.col(label) - F.col(prediction)
    squares = F.sum(error * error)
    spread = F.var_pop(actual) * F.count(actual)
    return predictions.filter(error.isNotNull()).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(squares, spread)).alias("r2"),
        F.count(F.lit(1)).alias("predictions_count"),
    )


def classification_metrics(
    predictions: DataFrame, label: str = "precip_class", prediction: str = "prediction"
) -> DataFrame:
    """``accuracy``, weighted ``precision`` and ``recall``, and ``predictions_count``.

    Everything is read off the confusion matrix. A class that is never
    predicted has precision zero.
    """
    actual, guess = F.col(label).cast("double"), F.col(prediction).cast("double")
    matrix = predictions.groupBy(actual.alias("actual"), guess.alias("guess")).agg(
        F.count(F.lit(1)).alias("n")
    )
    hit = F.when(F.col("actual") == F.col("guess"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("actual").alias("cls"), F.col("n").alias("rows"), F.lit(0).cast("long").alias("guesses"), hit.cast("long").alias("hits")),
        F.struct(F.col("guess").alias("cls"), F.lit(0).cast("long").alias("rows"), F.col("n").alias("guesses"), F.lit(0).cast("long").alias("hits")),
    )
    classes = (
        matrix.select(F.inline(sides))
        .groupBy("cls")
        .agg(*(F.sum(name).alias(name) for name in ("rows", "guesses", "hits")))
    )
    total, rows, hits = F.sum("rows"), F.col("rows"), F.col("hits")
    precision = F.coalesce(F.try_divide(hits, F.col("guesses")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(hits, rows), F.lit(0.0))
    return classes.agg(
        F.try_divide(F.sum("hits"), total).alias("accuracy"),
        F.try_divide(F.sum(rows * precision), total).alias("precision"),
        F.try_divide(F.sum(rows * recall), total).alias("recall"),
        F.coalesce(total, F.lit(0)).alias("predictions_count"),
    )
