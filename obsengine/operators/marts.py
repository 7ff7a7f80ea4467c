"""Result tables per place: monthly statistics, month patterns, extreme events.

The declared tables name their columns only; the rules below are this
library's. All tables start from one row per place and day, so that rows
repeated by station and alert matches are counted once.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsengine import constants as C
from obsengine.functions.columns import with_summary_categories
from obsengine.schemas import RESULT_TABLES


def _as_table(df: DataFrame, table: str) -> DataFrame:
    return df.select(
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in RESULT_TABLES[table].fields)
    )


def daily_grain(df: DataFrame, city: str = "city", date: str = "date") -> DataFrame:
    """One row per place and day: the day's extremes, highest rain and wind.

    Rows without a place or a date belong to no place's day and are left out.
    """
    return (
        df.filter(F.col(city).isNotNull() & F.col(date).isNotNull())
        .groupBy(F.col(city).alias("city"), F.col(date).alias("date"))
        .agg(
            F.max("temp_max").alias("temp_max"),
            F.min("temp_min").alias("temp_min"),
            F.max("precipitation").alias("precipitation"),
            F.max("windspeed_max").alias("windspeed_max"),
        )
    )


def _rainy_days() -> Column:
    return F.count_if(F.col("precipitation") > 0)


def city_temperature_stats(df: DataFrame, **names) -> DataFrame:
    """Per place, year and month: mean extremes, rain total, mean wind, rainy days."""
    return _as_table(
        daily_grain(df, **names)
        .groupBy("city", F.year("date").alias("year"), F.month("date").alias("month"))
        .agg(
            F.avg("temp_max").alias("avg_temp_max"),
            F.avg("temp_min").alias("avg_temp_min"),
            F.sum("precipitation").alias("total_precipitation"),
            F.avg("windspeed_max").alias("avg_windspeed"),
            _rainy_days().alias("days_with_rain"),
            F.max("temp_max").alias("extreme_temp_max"),
            F.min("temp_min").alias("extreme_temp_min"),
        ),
        "city_temperature_stats",
    )


def monthly_patterns(df: DataFrame, **names) -> DataFrame:
    """Per month of year and place: temperature, rain, and whether the month is wet.

    ``temperature_variance`` is the sample variance of the daily midpoint.
    ``seasonal_pattern`` is ``Wet`` if the month's mean daily rain exceeds the
    place's mean over all its days, else ``Dry``.
    """
    midpoint = (F.col("temp_max") + F.col("temp_min")) / 2
    place = Window.partitionBy("city")
    rain, days = F.col("total_precipitation"), F.col("_days")
    usual = F.try_divide(F.sum(rain).over(place), F.sum(days).over(place))
    return _as_table(
        daily_grain(df, **names)
        .groupBy("city", F.month("date").alias("month"))
        .agg(
            F.avg(midpoint).alias("avg_temperature"),
            F.sum("precipitation").alias("total_precipitation"),
            F.count("precipitation").alias("_days"),
            _rainy_days().alias("precipitation_days"),
            F.var_samp(midpoint).alias("temperature_variance"),
        )
        .withColumn(
            "seasonal_pattern",
            F.when(F.try_divide(rain, days) > usual, "Wet").otherwise("Dry"),
        ),
        "monthly_patterns",
    )


def extreme_events(
    df: DataFrame,
    heat_above: float = C.EXTREME_TEMPERATURE,
    rain_above: float = C.HIGH_PRECIPITATION,
    **names,
) -> DataFrame:
    """Runs of consecutive days above a cutoff, per place and event type.

    Types are ``heat`` (``temp_max``) and ``heavy_rain`` (``precipitation``).
    ``event_date`` is the first day; measures are the highest of the run;
    ``severity_score`` is the highest watched value divided by its cutoff.
    """
    watched = {"heat": ("temp_max", heat_above), "heavy_rain": ("precipitation", rain_above)}
    candidates = F.array(
        *(
            F.struct(
                F.lit(kind).alias("event_type"),
                F.col(measure).alias("_value"),
                F.lit(float(cutoff)).alias("_cutoff"),
            )
            for kind, (measure, cutoff) in watched.items()
        )
    )
    above = F.filter(candidates, lambda event: event["_value"] > event["_cutoff"])
    # A place has at most one row per calendar day here, so the window is bounded.
    days = Window.partitionBy("city", "event_type").orderBy("date")
    return _as_table(
        daily_grain(df, **names)
        .select("city", "date", "temp_max", "precipitation", "windspeed_max", F.inline(above))
        .withColumn("_run", F.date_sub("date", F.row_number().over(days)))
        .groupBy("city", "event_type", "_run")
        .agg(
            F.min("date").alias("event_date"),
            F.max("temp_max").alias("temperature_max"),
            F.max("precipitation").alias("precipitation"),
            F.max("windspeed_max").alias("windspeed_max"),
            F.max(F.col("_value") / F.col("_cutoff")).alias("severity_score"),
            F.count(F.lit(1)).alias("duration_days"),
        ),
        "extreme_events",
    )


def ml_predictions(predictions: DataFrame, version: str) -> DataFrame:
    """Temperature predictions as a result table.

    Only the maximum temperature is predicted: the other predicted columns and
    the confidence are typed nulls.
    """
    return _as_table(
        predictions.select(
            F.col("city_name").alias("city"),
            F.col("date").alias("prediction_date"),
            F.col("prediction").alias("predicted_temp_max"),
            F.lit(None).alias("predicted_temp_min"),
            F.lit(None).alias("predicted_precipitation"),
            F.lit(None).alias("confidence_score"),
            F.lit(version).alias("model_version"),
            F.current_timestamp().alias("prediction_timestamp"),
        ),
        "ml_predictions",
    )


def weather_summary(stats: DataFrame, from_year: int = C.SUMMARY_FROM_YEAR) -> DataFrame:
    """Monthly statistics from ``from_year`` on, with their categories."""
    return (
        stats.filter(F.col("year") >= from_year)
        .select(
            "city", "year", "month", "avg_temp_max", "avg_temp_min", "total_precipitation"
        )
        .transform(with_summary_categories)
    )
