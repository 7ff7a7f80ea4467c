"""Descriptive statistics per place.

Column names are keyword arguments. Metrics of measures that a frame lacks are
skipped. All aggregates combine map-side, so a place that holds a large share
of the rows costs its tasks a few partial rows, never the rows themselves.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsengine import constants as C
from obsengine.functions.columns import banded, with_temp_category

# Measures besides temperature whose mean each place reports, and their columns.
MEASURES = {"humidity": "humidity", "pressure": "pressure", "wind_speed": "wind_speed"}


def monthly_profile(
    df: DataFrame,
    city: str = "city",
    date: str = "date",
    temperature: str = "temperature",
    measures: Mapping[str, str] = MEASURES,
    cutoffs: Sequence[float] = C.TEMPERATURE_CUTOFFS,
) -> DataFrame:
    """Per place and month: everything that the descriptive tables are rolled up from.

    Moments of temperature, sums and counts of the other measures, counts per
    temperature category, and the set of days seen as one bit per day of month.
    Columns that a roll-up does not use are pruned from the plan.
    """
    value = F.col(temperature)
    present = {name: column for name, column in measures.items() if column in df.columns}
    category = banded(value, cutoffs, range(len(cutoffs) + 1))
    day_bit = F.call_function("shiftleft", F.lit(1), F.day(date) - 1)
    return df.groupBy(
        F.col(city).alias("city"), F.year(date).alias("year"), F.month(date).alias("month")
    ).agg(
        F.count(F.lit(1)).alias("observations"),
        F.count(value).alias("temperatures"),
        F.sum(value).alias("temperature_sum"),
        F.min(value).alias("temperature_min"),
        F.max(value).alias("temperature_max"),
        F.var_pop(value).alias("temperature_var"),
        F.bit_or(day_bit).alias("days_seen"),
        *(F.count_if(category == i).alias(f"category_{i}") for i in range(len(cutoffs) + 1)),
        *(F.sum(column).alias(f"{name}_sum") for name, column in present.items()),
        *(F.count(column).alias(f"{name}_count") for name, column in present.items()),
    )


def _mean(total: str, count: str) -> Column:
    return F.try_divide(F.sum(total), F.sum(count))


def _profiled_means(profile: DataFrame) -> dict[str, Column]:
    names = [name for name in MEASURES if f"{name}_sum" in profile.columns]
    return {f"avg_{name}": _mean(f"{name}_sum", f"{name}_count") for name in names}


def summary_from_profile(profile: DataFrame) -> DataFrame:
    """:func:`summary_statistics` rolled up from :func:`monthly_profile`."""
    # Squared deviations within months plus those of the monthly means: the
    # window holds one row per month of a place.
    place = Window.partitionBy("city")
    overall = F.try_divide(
        F.sum("temperature_sum").over(place), F.sum("temperatures").over(place)
    )
    monthly = F.try_divide(F.col("temperature_sum"), F.col("temperatures"))
    squares = F.col("temperatures") * (
        F.col("temperature_var") + F.pow(monthly - F.col("_overall"), F.lit(2))
    )
    samples = F.sum("temperatures")
    return (
        profile.withColumn("_overall", overall)
        .groupBy("city")
        .agg(
            F.sum("observations").alias("total_observations"),
            _mean("temperature_sum", "temperatures").alias("avg_temperature"),
            F.min("temperature_min").alias("min_temperature"),
            F.max("temperature_max").alias("max_temperature"),
            F.sqrt(F.try_divide(F.sum(squares), F.when(samples > 1, samples - 1))).alias(
                "std_temperature"
            ),
            *(value.alias(name) for name, value in _profiled_means(profile).items()),
            F.coalesce(F.sum(F.bit_count("days_seen")), F.lit(0)).alias("days_with_data"),
        )
        .orderBy("city")
    )


def summary_statistics(df: DataFrame, **names) -> DataFrame:
    """Per place: count, temperature statistics, means, and distinct days, by place.

    Days are counted exactly from one bit per day and month, so the distinct
    count shuffles one number per place and month instead of every date.
    """
    return summary_from_profile(monthly_profile(df, **names))


def trends_from_profile(profile: DataFrame) -> DataFrame:
    """:func:`monthly_trends` from :func:`monthly_profile`."""
    return profile.select(
        "city",
        "year",
        "month",
        F.try_divide("temperature_sum", "temperatures").alias("avg_monthly_temp"),
        F.col("temperature_min").alias("min_monthly_temp"),
        F.col("temperature_max").alias("max_monthly_temp"),
        F.col("observations").alias("observations_count"),
    ).orderBy("city", "year", "month")


def monthly_trends(df: DataFrame, **names) -> DataFrame:
    """Per place, year and month: temperature mean, extremes and row count."""
    return trends_from_profile(monthly_profile(df, **names))


def _with_range(extremes: DataFrame) -> DataFrame:
    return extremes.withColumn("temperature_range", F.col("highest_temp") - F.col("lowest_temp"))


def extremes_from_profile(profile: DataFrame) -> DataFrame:
    """:func:`extreme_temperatures` from :func:`monthly_profile`."""
    return _with_range(
        profile.groupBy("city").agg(
            F.max("temperature_max").alias("highest_temp"),
            F.min("temperature_min").alias("lowest_temp"),
        )
    )


def extreme_temperatures(
    df: DataFrame, city: str = "city", temperature: str = "temperature"
) -> DataFrame:
    """Per place: highest and lowest temperature and their difference."""
    return _with_range(
        df.groupBy(F.col(city).alias("city")).agg(
            F.max(temperature).alias("highest_temp"), F.min(temperature).alias("lowest_temp")
        )
    )


def distribution_from_profile(
    profile: DataFrame, labels: Sequence[str] = C.TEMPERATURE_LABELS
) -> DataFrame:
    """:func:`temperature_distribution` from :func:`monthly_profile`."""
    totals = profile.groupBy("city").agg(
        *(F.sum(f"category_{i}").alias(f"category_{i}") for i in range(len(labels)))
    )
    counted = F.array(
        *(
            F.struct(F.lit(label).alias("temp_category"), F.col(f"category_{i}").alias("days_count"))
            for i, label in enumerate(labels)
        )
    )
    return (
        totals.select("city", F.inline(counted))
        .filter(F.col("days_count") > 0)
        .orderBy("city", "temp_category")
    )


def temperature_distribution(
    df: DataFrame,
    city: str = "city",
    temperature: str = "temperature",
    cutoffs: Sequence[float] = C.TEMPERATURE_CUTOFFS,
    labels: Sequence[str] = C.TEMPERATURE_LABELS,
) -> DataFrame:
    """Rows per place and temperature category (``days_count`` counts rows, not days)."""
    return (
        with_temp_category(df, temperature, cutoffs, labels)
        .groupBy(F.col(city).alias("city"), "temp_category")
        .agg(F.count(F.lit(1)).alias("days_count"))
        .orderBy("city", "temp_category")
    )


def humidity_analysis(
    df: DataFrame,
    city: str = "city",
    humidity: str = "humidity",
    accuracy: int = C.QUARTILE_ACCURACY,
) -> DataFrame:
    """Per place: mean humidity and quartiles of rank error at most ``1 / accuracy``.

    The three quartiles come from one sketch, merged from per-task sketches
    whose size depends on ``accuracy`` and not on the rows.
    """
    quartiles = F.percentile_approx(humidity, [0.25, 0.5, 0.75], accuracy)
    return (
        df.groupBy(F.col(city).alias("city"))
        .agg(F.avg(humidity).alias("avg_humidity"), quartiles.alias("_q"))
        .select(
            "city",
            "avg_humidity",
            F.col("_q")[0].alias("humidity_q1"),
            F.col("_q")[1].alias("humidity_median"),
            F.col("_q")[2].alias("humidity_q3"),
        )
    )


def place_averages(
    df: DataFrame,
    city: str = "city",
    temperature: str = "temperature",
    humidity: str = "humidity",
) -> DataFrame:
    """Per place: mean temperature and humidity, the input of the rankings."""
    return df.groupBy(F.col(city).alias("city")).agg(
        F.avg(temperature).alias("avg_temperature"), F.avg(humidity).alias("avg_humidity")
    )


def averages_from_profile(profile: DataFrame) -> DataFrame:
    """:func:`place_averages` from :func:`monthly_profile`."""
    humidity = _profiled_means(profile).get("avg_humidity", F.lit(None).cast("double"))
    return profile.groupBy("city").agg(
        _mean("temperature_sum", "temperatures").alias("avg_temperature"),
        humidity.alias("avg_humidity"),
    )


def cluster_statistics(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Per cluster: row count and mean features, by cluster."""
    return (
        df.groupBy(F.col(cluster).alias("cluster"))
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg("temp_avg").alias("avg_temp"),
            F.avg("temp_range").alias("avg_temp_range"),
            F.avg("precipitation").alias("avg_precipitation"),
        )
        .orderBy("cluster")
    )
