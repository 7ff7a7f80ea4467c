"""File sinks."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsengine.session import materialize
from obsengine.sources.readers import read_trusted


def write_trusted(df: DataFrame, path: str, replace_all: bool = True, by_date: bool = False) -> None:
    """Overwrite Parquet partitioned by ``date``.

    Rows are rebalanced by date at run time: small dates share a task and one
    that holds much of the data is split over several files. Say ``by_date`` if
    they are dealt so already, as ``enrich(..., by_date=True)`` does: they do not move again.
    With ``replace_all=False`` only the dates present in ``df`` are replaced.
    """
    mode = "static" if replace_all else "dynamic"
    writer = (
        (df if by_date else df.hint("rebalance", "date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy("date")
    )
    writer.parquet(path)


def merge_trusted(df: DataFrame, path: str, keys: Sequence[str] = ("weather_city", "date")) -> None:
    """Merge late trusted rows: they replace all stored rows of the same place and day.

    Only the dates of ``df`` are read and rewritten; the files of other dates
    stay as they are, and so do other places of the same dates. Rows with a
    null in their key replace nothing and are added. Repeated days of one batch
    are folded before enrichment, by ``latest_observations``. The merged rows
    are stored before the first stored date is replaced, so a run that fails
    can be repeated; without rows nothing changes.
    """
    spark = df.sparkSession
    late = materialize(df, "late-rows")
    # As many as there are days in the calendar of the batch.
    dates = [row.date for row in late.select("date").distinct().collect()]
    if not dates:
        return
    touched = F.col("date").isin([d for d in dates if d is not None])
    if None in dates:
        touched = touched | F.col("date").isNull()
    stored = read_trusted(spark, path).filter(touched)
    kept = stored.join(late.select(*keys).distinct(), list(keys), "left_anti")
    merged = materialize(kept.select(*late.columns).union(late), "merged-rows")
    write_trusted(merged, path, replace_all=False)


def write_parquet(df: DataFrame, path: str) -> None:
    """Overwrite plain Parquet, in as many files as ``df`` has partitions."""
    df.write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """Overwrite JSON, one object per line."""
    df.write.mode("overwrite").json(path)


def write_quarantine(records: DataFrame, path: str) -> int:
    """Write malformed records with their files as JSON lines; returns how many there are."""
    seen = Observation()
    records.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(path)
    return seen.get["n"]


def land_batch(df: DataFrame, root: str, batch_id: str) -> str:
    """Write one raw batch, one object per line, under its own folder; returns the folder.

    Read it back with ``read_observations(..., multi_line=False)``. A batch
    that is already there is an error, so a repeated run cannot double it.
    """
    path = f"{root.rstrip('/')}/batch={batch_id}"
    df.write.mode("error").json(path)
    return path


def save_results(
    results: Mapping[str, DataFrame],
    root: str,
    order: Mapping[str, Sequence[str]] | None = None,
    single_file: bool = True,
    stored: bool = False,
) -> None:
    """Write each table as Parquet and as headered CSV, sorted by its ``order`` columns.

    Each table is computed once and stored; both formats copy the stored rows.
    Say ``stored`` if the tables are read from files already.
    ``single_file`` writes one file per table and format, whatever its size:
    one task then writes the table. Without it a table becomes one file per
    range of its order.
    """
    order = order or {}
    root = root.rstrip("/")
    for name, df in results.items():
        table = df if stored else materialize(df, name)
        rows = _laid_out(table, order.get(name, ()), single_file)
        parquet = rows.write.mode("overwrite").option("compression", "snappy")
        parquet.parquet(f"{root}/descriptive_analytics/{name}")
        csv = rows.write.mode("overwrite").option("header", True)
        csv.csv(f"{root}/descriptive_analytics_csv/{name}")


def _laid_out(stored: DataFrame, order: Sequence[str], single_file: bool) -> DataFrame:
    if single_file:
        one = stored.coalesce(1)
        return one.sortWithinPartitions(*order) if order else one
    return stored.orderBy(*order) if order else stored


# Texts that CSV can't tell apart are written with a backslash: null, empty, and a leading one.
_NULL, _EMPTY = "\\N", "\\E"
_CSV = {
    "header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def _as_text(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_trunc("second", column) == column
        seconds = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
        micros = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        column = F.when(whole, seconds).otherwise(micros)
    elif isinstance(field.dataType, T.StringType):
        marked = F.when(column == "", _EMPTY).when(
            F.startswith(column, F.lit("\\")), F.concat(F.lit("\\"), column)
        )
        column = F.when(column.isNull(), _NULL).otherwise(F.coalesce(marked, column))
    return column.alias(field.name)


def _from_text(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        plain = F.when(F.startswith(column, F.lit("\\")), F.substr(column, F.lit(2)))
        column = F.when(column == _EMPTY, "").when(
            column != _NULL, F.coalesce(plain, column)
        )
    return column.cast(field.dataType).alias(field.name)


SNAPSHOT_MANIFEST = T.StructType(
    [
        T.StructField("table", T.StringType(), False),
        T.StructField("location", T.StringType(), False),
        T.StructField("records_count", T.LongType(), False),
    ]
)


def snapshot_tables(
    spark: SparkSession, tables: Mapping[str, DataFrame], root: str, stamp: str
) -> DataFrame:
    """Export each table to headered CSV under ``root``; returns one row per export.

    Empty tables are skipped and timestamps become ISO text. Null text is
    written as ``\\N``, empty text as ``\\E``, and a leading backslash is doubled, so
    that :func:`read_snapshot` gets back what was written. Rows are counted
    while they are written.
    """
    written = []
    for name, df in tables.items():
        if df.isEmpty():
            continue
        path = f"{root.rstrip('/')}/database_exports/{name}_{stamp}"
        seen = Observation()
        rows = df.select(*(_as_text(field) for field in df.schema.fields))
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").options(
            **_CSV
        ).csv(path)
        written.append((name, path, seen.get["n"]))
    return spark.createDataFrame(written, SNAPSHOT_MANIFEST)


def read_snapshot(
    spark: SparkSession, exports: str, name: str, stamp: str, schema: T.StructType
) -> DataFrame:
    """The rows of one table in one snapshot, its columns found by name.

    Text may hold line breaks, so a file is read by one task.
    """
    path = f"{exports.rstrip('/')}/{name}_{stamp}"
    rows = spark.read.options(**_CSV, multiLine=True).csv(path)
    return rows.select(*(_from_text(field) for field in schema.fields))
