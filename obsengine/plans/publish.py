"""Result tables and the summary view, published to the catalog."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsengine import constants as C
from obsengine.operators import marts
from obsengine.session import materialize
from obsengine.sources import catalog


def left_out_records(trusted: DataFrame, city: str = "city_name") -> int:
    """How many trusted rows have no place or no date, and so are in no result table."""
    return trusted.filter(F.col(city).isNull() | F.col("date").isNull()).count()


def publish_results(
    spark: SparkSession,
    trusted: DataFrame,
    database: str,
    root: str,
    predictions: DataFrame | None = None,
    model_version: str = "1",
    from_year: int = C.SUMMARY_FROM_YEAR,
    city: str = "city_name",
) -> list[str]:
    """Build and register every result table of trusted rows; returns the table names.

    ``city`` is the column that names a row's place. The trusted rows are folded to one row per place and day once, for all
    tables. ``predictions`` are the scored rows of the temperature model.
    """
    root = root.rstrip("/")
    daily = materialize(marts.daily_grain(trusted, city=city), "daily")
    tables = {
        "city_temperature_stats": marts.city_temperature_stats(daily),
        "monthly_patterns": marts.monthly_patterns(daily),
        "extreme_events": marts.extreme_events(daily),
    }
    if predictions is not None:
        tables["ml_predictions"] = marts.ml_predictions(predictions, model_version)
    catalog.ensure_database(spark, database, f"{root}/database")
    for name, rows in tables.items():
        catalog.publish(spark, rows, database, name, f"{root}/{name}")
    catalog.create_weather_summary(spark, database, from_year)
    return [*tables, "weather_summary"]
