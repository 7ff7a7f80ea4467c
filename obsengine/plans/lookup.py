"""Lookups of published results by place and period."""

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Dataset -> (table, columns kept, how a row's time is found).
DATASETS = {
    "cities": ("city_temperature_stats", None, "month"),
    "monthly": ("monthly_patterns", None, "season"),
    "extreme-events": ("extreme_events", None, "event_date"),
    "precipitation": (
        "city_temperature_stats",
        ("city", "year", "month", "total_precipitation", "days_with_rain"),
        "month",
    ),
    "ml-predictions": ("ml_predictions", None, "prediction_date"),
    "summary": ("weather_summary", None, "month"),
}


def _month_bound(bound: date, sign: int) -> Column:
    # Plain comparisons of year and month reach the Parquet scan.
    year, month = F.col("year"), F.col("month")
    if sign > 0:
        return (year > bound.year) | ((year == bound.year) & (month >= bound.month))
    return (year < bound.year) | ((year == bound.year) & (month <= bound.month))


def select_period(
    df: DataFrame, time: str, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Rows of a period, both ends included.

    ``time`` is a date column, or ``month`` for rows of a year and month, which
    are kept if their month touches the period. ``event_date`` rows last for
    ``duration_days`` and are kept if any of their days is in the period.
    ``season`` rows belong to no year, so a period does not apply to them.
    """
    if time == "season":
        if start or end:
            raise ValueError("month-of-year rows belong to no period")
        return df
    if start and time == "event_date":
        last = F.date_add(time, (F.col("duration_days") - 1).cast("int"))
        df = df.filter(last >= F.lit(start))
    elif start:
        df = df.filter(_month_bound(start, 1) if time == "month" else F.col(time) >= F.lit(start))
    if end:
        df = df.filter(_month_bound(end, -1) if time == "month" else F.col(time) <= F.lit(end))
    return df


def lookup(
    spark: SparkSession,
    database: str,
    dataset: str,
    city: str | None = None,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Published rows of ``dataset``, optionally of one place and one period."""
    if dataset not in DATASETS:
        raise ValueError(f"unknown dataset {dataset!r}; choose one of {sorted(DATASETS)}")
    table, columns, time = DATASETS[dataset]
    df = spark.table(f"`{database}`.`{table}`")
    if city is not None:
        df = df.filter(F.col("city") == city)
    df = select_period(df, time, start, end)
    return df.select(*columns) if columns else df
