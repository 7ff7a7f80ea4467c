"""File sources."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsengine import schemas

# Observations with the text of a record that can't be read as one.
_WITH_TEXT = T.StructType([*schemas.RAW_OBSERVATION.fields, T.StructField("_malformed", T.StringType())])

MEASURES = ("temp_max", "temp_min", "precipitation", "windspeed_max")


def _typed_times(df: DataFrame) -> DataFrame:
    # Text that is no date becomes null instead of failing the batch.
    return df.withColumns(
        {
            "date": F.try_to_date("date"),
            "extraction_timestamp": F.try_to_timestamp("extraction_timestamp"),
        }
    )


# Between two elements of an array of flat objects: a comma after or before a brace.
_BETWEEN = r"(?<=\})\s*,\s*|\s*,\s*(?=\{)"


def _elements(text: Column) -> Column:
    """The elements of a JSON array as texts, however broken single ones are.

    A valid array is taken apart by the parser. Otherwise it is cut between
    objects, so that a broken one is a text of its own; a single object is an
    array of one.
    """
    bare = F.regexp_replace(F.regexp_replace(text, r"^\s*\[", ""), r"\]\s*$", "")
    valid = F.json_array_length(text).isNotNull()
    return F.when(valid, F.from_json(text, "array<string>")).otherwise(F.split(bare, _BETWEEN))


def _checked(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """(file, record, observation, good): every record of the raw files with its text."""
    text = spark.read.text(path, wholetext=multi_line)
    file, value = F.col("_metadata.file_path").alias("file"), F.col("value")
    records = text.select(file, F.explode(_elements(value)) if multi_line else value).toDF("file", "record")
    parsed = F.from_json("record", _WITH_TEXT, {"columnNameOfCorruptRecord": "_malformed"})
    good = F.col("observation._malformed").isNull() & F.col("record").rlike(r"^\s*\{")
    return (
        records.filter(F.col("record").isNull() | F.col("record").rlike(r"\S"))
        .withColumn("observation", parsed)
        .withColumn("good", F.coalesce(good, F.lit(False)))
    )


def read_observations(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Well-formed raw JSON observations under a path or glob.

    ``multi_line`` reads files that hold one JSON array each, one task per
    file. Pass ``False`` for one object per line, which splits within files.
    A record that is no object or has a value of another type is left out and
    costs no other record; :func:`quarantined_observations` returns it.
    """
    checked = _checked(spark, path, multi_line).filter("good")
    return _typed_times(checked.select(*(F.col("observation")[c].alias(c) for c in schemas.RAW_OBSERVATION.names)))


def quarantined_observations(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """(file, record): the texts of the malformed records, which :func:`read_observations` leaves out."""
    return _checked(spark, path, multi_line).filter("NOT good").select("file", "record")


def read_payloads(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Landed API payloads: one document per place and request."""
    return spark.read.schema(schemas.API_PAYLOAD).option("multiLine", multi_line).json(path)


def unpivot_daily_payload(df: DataFrame, impute_zero: bool = True) -> DataFrame:
    """One row per place and day from payloads of parallel arrays.

    Arrays are matched by position and shorter ones are padded with null.
    ``impute_zero`` turns missing measures into zero; ``False`` keeps them null.
    """
    daily = F.arrays_zip(
        F.col("daily.time").alias("date"),
        F.col("daily.temperature_2m_max").alias("temp_max"),
        F.col("daily.temperature_2m_min").alias("temp_min"),
        F.col("daily.precipitation_sum").alias("precipitation"),
        F.col("daily.windspeed_10m_max").alias("windspeed_max"),
    )
    rows = df.select(
        "city", "latitude", "longitude", "extraction_timestamp", F.inline(daily)
    ).filter(F.col("date").isNotNull())

    def measure(name: str) -> Column:
        return F.coalesce(name, F.lit(0.0)) if impute_zero else F.col(name)

    return _typed_times(rows).select(
        "city",
        "latitude",
        "longitude",
        "date",
        *(measure(name).alias(name) for name in MEASURES),
        "extraction_timestamp",
    )


def latest_observations(df: DataFrame, keys: tuple[str, ...] = ("city", "date")) -> DataFrame:
    """One row per key: that of the latest extraction.

    Overlapping batches repeat days. Copies fold map-side, and rows of equal
    extraction time are told apart by their values. Rows with a null in their
    key, such as a date that could not be read, are not copies of each other:
    all of them stay.
    """
    ordered = ["extraction_timestamp", *(c for c in df.columns if c not in (*keys, "extraction_timestamp"))]
    whole = reduce(Column.__and__, (F.col(key).isNotNull() for key in keys))
    latest = df.filter(whole).groupBy(*keys).agg(F.max(F.struct(*ordered)).alias("_latest"))
    folded = latest.select(*keys, "_latest.*").select(*df.columns)
    return folded.union(df.filter(~whole))


def read_trusted(spark: SparkSession, path: str) -> DataFrame:
    """Trusted rows, with ``date`` from the directory names."""
    return spark.read.schema(schemas.TRUSTED).parquet(path)


def read_non_empty(spark: SparkSession, path: str) -> DataFrame:
    """Parquet rows; raises ``ValueError`` if there are none."""
    df = spark.read.parquet(path)
    if df.isEmpty():
        raise ValueError(f"no observations under {path}")
    return df
