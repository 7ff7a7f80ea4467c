"""Catalog: databases, result tables and the summary view."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from obsengine import constants as C
from obsengine.functions.columns import SUMMARY_CATEGORIES
from obsengine.schemas import GENERIC_TABLE, RESULT_TABLES


def _quoted(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database if it is missing."""
    where = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)}{where}")


def declared_schema(name: str) -> T.StructType:
    """Schema of a known result table; one text column for any other."""
    return RESULT_TABLES.get(name, GENERIC_TABLE)


def register_table(
    spark: SparkSession,
    database: str,
    name: str,
    location: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Register a result location as a table, unless it exists, and return the table.

    Its columns are those of ``schema``, or else the declared ones.
    """
    if not fmt.isidentifier():
        raise ValueError(f"not a format name: {fmt!r}")
    columns = ", ".join(
        f"{_quoted(field.name)} {field.dataType.simpleString()}"
        for field in (schema or declared_schema(name)).fields
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quoted(database, name)} ({columns}) "
        f"USING {fmt} LOCATION {_text(location)}"
    )
    return spark.table(_quoted(database, name))


def _columns(schema: T.StructType) -> list[tuple[str, str]]:
    return [(field.name, field.dataType.simpleString()) for field in schema.fields]


#: Rows of a row group of a published table: what a lookup reads at least.
GROUP_ROWS = 100_000


def publish(
    spark: SparkSession,
    df: DataFrame,
    database: str,
    name: str,
    location: str,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Write a new version of a result table and switch its readers to it.

    A version is a folder of its own below ``location``. It is its own index:
    rows are sorted by place and period and cut into groups of ``group_rows``,
    whose extremes and Bloom filters of places let a lookup skip all groups
    but those of its place and period. The
    table moves to the version only when it is written whole: a write that
    fails leaves the rows published before, and running readers keep their
    files until :func:`drop_versions`. A table whose name is not a declared one
    has the columns of ``df``; if they change it is registered anew.
    """
    keys = [c for c in ("city", "year", "month", "event_date", "prediction_date") if c in df.columns]
    rows = df.sort(*keys) if keys else df
    version = f"{location.rstrip('/')}/v-{uuid.uuid4().hex}"
    writer = rows.write.mode("error").option("parquet.block.row.count.limit", group_rows)
    if "city" in df.columns:
        writer = writer.option("parquet.bloom.filter.enabled#city", True)
    writer.parquet(version)
    table = _quoted(database, name)
    schema = RESULT_TABLES.get(name, df.schema)
    if spark.catalog.tableExists(table) and _columns(spark.table(table).schema) != _columns(schema):
        spark.sql(f"DROP TABLE {table}")
    register_table(spark, database, name, version, schema=schema)
    spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(version)}")
    spark.sql(f"REFRESH TABLE {table}")
    return spark.table(table)


def current_location(spark: SparkSession, database: str, name: str) -> str:
    """The folder that a registered table reads."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(database, name)}")
    return described.filter("col_name = 'Location'").first().data_type


def drop_versions(spark: SparkSession, database: str, name: str, keep: int = 0) -> list[str]:
    """Delete the versions beside the published one but the ``keep`` youngest; returns the deleted folders.

    Call it when no reader of an earlier version is left. The published version
    is never deleted, nor is anything that is no version.
    """
    new_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    current = new_path(current_location(spark, database, name))
    files = current.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    beside = files.listStatus(current.getParent())
    others = [f for f in beside if f.getPath().getName().startswith("v-") and f.getPath().getName() != current.getName()]
    others.sort(key=lambda f: (f.getModificationTime(), f.getPath().getName()), reverse=True)
    gone = [f.getPath() for f in others[keep:]]
    for path in gone:
        files.delete(path, True)
    return [str(path.toString()) for path in gone]


def create_weather_summary(
    spark: SparkSession, database: str, from_year: int = C.SUMMARY_FROM_YEAR
) -> DataFrame:
    """Create or replace the ``weather_summary`` view over the monthly statistics."""
    view = _quoted(database, "weather_summary")
    stats = _quoted(database, "city_temperature_stats")
    categories = ", ".join(f"{rule} AS {name}" for name, rule in SUMMARY_CATEGORIES.items())
    spark.sql(
        f"""CREATE OR REPLACE VIEW {view} AS
        SELECT city, year, month, avg_temp_max, avg_temp_min, total_precipitation, {categories}
        FROM {stats} WHERE year >= {int(from_year)}"""
    )
    return spark.table(view)
