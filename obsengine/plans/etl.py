"""Raw inputs to trusted rows."""

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from obsengine.plans.enrich import enrich
from obsengine.plans.reports import quality_counts
from obsengine.sources.writers import merge_trusted, write_trusted


def run_etl(
    observations: DataFrame,
    cities: DataFrame,
    stations: DataFrame,
    alerts: DataFrame,
    path: str,
    **options,
) -> dict[str, float | int | str | None]:
    """Enrich, write the trusted zone, and report its quality.

    The counts are observed while the rows are written: the plan runs once.
    """
    write = partial(write_trusted, by_date=True)
    return _reported(write, enrich(observations, cities, stations, alerts, by_date=True, **options), path)


def merge_etl(
    observations: DataFrame,
    cities: DataFrame,
    stations: DataFrame,
    alerts: DataFrame,
    path: str,
    **options,
) -> dict[str, float | int | str | None]:
    """Enrich late or corrected observations and merge them into the trusted zone.

    The report counts the merged rows, not those that were there before.
    """
    return _reported(merge_trusted, enrich(observations, cities, stations, alerts, by_date=True, **options), path)


def _reported(
    write: Callable[[DataFrame, str], None], trusted: DataFrame, path: str
) -> dict[str, float | int | str | None]:
    quality = Observation("quality")
    undated = F.count_if(F.col("date").isNull()).alias("undated_records")
    write(trusted.observe(quality, *quality_counts(), undated), path)
    total, valid = quality.get["total_records"], quality.get["valid_records"]
    return {
        "status": "success",
        "total_records": total,
        "valid_records": valid,
        "undated_records": quality.get["undated_records"],
        "data_quality": 100 * valid / total if total else None,
    }
