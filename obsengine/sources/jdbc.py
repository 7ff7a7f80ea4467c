"""Database sources. Credentials come from the caller or the environment only."""

import os
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Partitioning:
    """Split of a database read into ``count`` parallel range scans of ``column``.

    The bounds shape the ranges only; rows outside them are still read.
    """

    column: str
    lower: int | str
    upper: int | str
    count: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.count),
        }


def connection_properties(
    prefix: str = "OBSENGINE_DB_", environ: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Reader options from variables such as ``<prefix>USER`` and ``<prefix>PASSWORD``."""
    environ = os.environ if environ is None else environ
    return {
        key.removeprefix(prefix).lower(): value
        for key, value in environ.items()
        if key.startswith(prefix)
    }


def jdbc_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partitioning: Partitioning | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of one JDBC read; a MySQL ``url`` streams rows instead of buffering them."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if url.startswith("jdbc:mysql:"):
        options["useCursorFetch"] = "true"
    options.update(properties or {})
    if partitioning:
        options.update(partitioning.options())
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partitioning: Partitioning | None = None,
) -> DataFrame:
    """One database table. Filters and column choices on it are pushed to the database."""
    options = jdbc_options(url, table, properties, partitioning)
    return spark.read.format("jdbc").options(**options).load()


def read_jdbc_query(
    spark: SparkSession,
    url: str,
    query: str,
    properties: Mapping[str, str] | None = None,
    partitioning: Partitioning | None = None,
) -> DataFrame:
    """The rows of ``query``, which the database runs.

    The query is read as a derived table, since a plain query option cannot be
    split into parallel scans.
    """
    return read_jdbc(spark, url, f"({query}) extract_rows", properties, partitioning)


def events_since(events: DataFrame, since: date = date(2023, 1, 1)) -> DataFrame:
    """Historical events from ``since`` on, in a form that a database scan pushes down."""
    return events.filter(F.col("event_date") >= F.lit(since)).select(
        "event_id", "city_id", "event_date", "event_type", "severity", "description"
    )
