"""Derived columns and row filters.

Every transform takes and returns a DataFrame, so calls chain with
``df.transform``. A comparison with null is not true: such rows fall to the
last branch of each rule.
"""

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsengine import constants as C


def conform(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the mapped columns, renamed ``source -> target``."""
    return df.select(*(F.col(source).alias(target) for source, target in mapping.items()))


OBSERVATION_NAMES = {
    "latitude": "lat",
    "longitude": "lon",
    "date": "date",
    "temp_max": "temp_max",
    "temp_min": "temp_min",
    "precipitation": "precipitation",
    "windspeed_max": "windspeed_max",
    "city": "weather_city",
}
CITY_NAMES = {
    "name": "city_name",
    "department": "department",
    "latitude": "city_lat",
    "longitude": "city_lon",
    "population": "population",
}
STATION_NAMES = {
    "station_name": "station_name",
    "city": "station_city",
    "latitude": "station_lat",
    "longitude": "station_lon",
    "altitude": "altitude",
    "status": "status",
}
ALERT_NAMES = {
    "city": "alert_city",
    "alert_type": "alert_type",
    "severity": "severity",
    "threshold_value": "threshold_value",
    "is_active": "is_active",
}


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def with_temp_avg(df: DataFrame) -> DataFrame:
    """``temp_avg``: midpoint of the day's extremes."""
    return df.withColumn("temp_avg", (F.col("temp_max") + F.col("temp_min")) / 2)


def with_temp_range(df: DataFrame) -> DataFrame:
    """``temp_range``: spread of the day's extremes."""
    return df.withColumn("temp_range", F.col("temp_max") - F.col("temp_min"))


def with_alert_triggered(
    df: DataFrame, measures: Mapping[str, str] = C.ALERT_MEASURES
) -> DataFrame:
    """``alert_triggered``: the watched measure is strictly above the alert's threshold.

    ``is_active`` plays no part, and an unknown alert type never fires.
    """
    fires = [
        (F.col("alert_type") == kind) & (F.col(measure) > F.col("threshold_value"))
        for kind, measure in measures.items()
    ]
    return df.withColumn(
        "alert_triggered", F.coalesce(reduce(Column.__or__, fires), F.lit(False))
    )


def with_quality_score(
    df: DataFrame, required: Sequence[str] = ("city_name", "station_name")
) -> DataFrame:
    """``data_quality_score``: lower when any required column is null."""
    missing = reduce(Column.__or__, (F.col(name).isNull() for name in required))
    return df.withColumn(
        "data_quality_score",
        F.when(missing, F.lit(C.SCORE_PARTIAL)).otherwise(F.lit(C.SCORE_COMPLETE)),
    )


def with_calendar(df: DataFrame, date: str = "date") -> DataFrame:
    """``year``, ``month`` and ``day_of_year`` of a date column."""
    return df.withColumns(
        {"year": F.year(date), "month": F.month(date), "day_of_year": F.dayofyear(date)}
    )


def with_flags(
    df: DataFrame,
    rain_above: float = C.HIGH_PRECIPITATION,
    heat_above: float = C.EXTREME_TEMPERATURE,
) -> DataFrame:
    """0/1 columns ``high_precipitation`` and ``extreme_temp``."""
    return df.withColumns(
        {
            "high_precipitation": _flag(F.col("precipitation") > rain_above),
            "extreme_temp": _flag(F.col("temp_max") > heat_above),
        }
    )


def with_precip_class(df: DataFrame, above: float = C.RAINY_CLASS) -> DataFrame:
    """0/1 label ``precip_class``."""
    return df.withColumn("precip_class", _flag(F.col("precipitation") > above))


def banded(value: Column, cutoffs: Sequence[float], labels: Sequence) -> Column:
    """Label of the first cutoff that ``value`` is below; the last label otherwise."""
    if len(labels) != len(cutoffs) + 1:
        raise ValueError("need one more label than cutoffs")
    branches = F
    for cutoff, label in zip(cutoffs, labels):
        branches = branches.when(value < cutoff, F.lit(label))
    return branches.otherwise(F.lit(labels[-1]))


def with_temp_category(
    df: DataFrame,
    temperature: str = "temperature",
    cutoffs: Sequence[float] = C.TEMPERATURE_CUTOFFS,
    labels: Sequence[str] = C.TEMPERATURE_LABELS,
) -> DataFrame:
    """``temp_category``; a null temperature takes the warmest label."""
    return df.withColumn("temp_category", banded(F.col(temperature), cutoffs, labels))


#: The categories of a monthly row in SQL, for views and for frames.
SUMMARY_CATEGORIES = {
    "temperature_category": (
        f"CASE WHEN avg_temp_max > {C.HOT_ABOVE} THEN 'Hot' "
        f"WHEN avg_temp_max < {C.COLD_BELOW} THEN 'Cold' ELSE 'Moderate' END"
    ),
    "precipitation_category": (
        f"CASE WHEN total_precipitation > {C.RAIN_HIGH_ABOVE} THEN 'High' "
        f"WHEN total_precipitation > {C.RAIN_MEDIUM_ABOVE} THEN 'Medium' ELSE 'Low' END"
    ),
}


def with_summary_categories(df: DataFrame) -> DataFrame:
    """``temperature_category`` and ``precipitation_category`` of a monthly row."""
    return df.withColumns({name: F.expr(rule) for name, rule in SUMMARY_CATEGORIES.items()})


def available(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Those of ``names`` that ``df`` has, in the order given."""
    present = set(df.columns)
    return [name for name in names if name in present]


def fill_zero(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Replace nulls with zero in those of ``names`` that exist; NaN is a value and stays."""
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(0).cast(df.schema[name].dataType))
            for name in available(df, names)
        }
    )


def with_error(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Add ``error``: how far the prediction is from the label."""
    return df.withColumn("error", F.abs(F.col(label) - F.col(prediction)))


def complete_rows(
    df: DataFrame,
    required: Sequence[str] = ("temp_max", "temp_min", "precipitation", "city_name"),
) -> DataFrame:
    """Rows in which every required column is non-null (NaN counts as a value)."""
    return df.filter(reduce(Column.__and__, (F.col(name).isNotNull() for name in required)))
