"""Stored monthly profiles that grow by batches.

A profile row holds counts, sums, extremes, the variance and the days seen of
one place and month. Rows of the same place and month merge to what one pass
over all their observations would give, so a batch of new observations is
profiled alone and added; earlier observations are not read again.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsengine.operators.aggregates import monthly_profile

KEYS = ("city", "year", "month")


def merged_profile(parts: DataFrame) -> DataFrame:
    """One row per place and month out of partial rows that share no observation.

    Variances merge around the common mean: the squared deviations of a part
    are its own and those of its mean. Days are united as bits.
    """
    month = Window.partitionBy(*KEYS)  # as many rows as batches that touch the month
    overall = F.try_divide(F.sum("temperature_sum").over(month), F.sum("temperatures").over(month))
    shift = F.try_divide("temperature_sum", "temperatures") - F.col("_overall")
    squares = F.col("temperatures") * (F.col("temperature_var") + shift * shift)
    special = {
        "temperature_min": F.min("temperature_min"),
        "temperature_max": F.max("temperature_max"),
        "temperature_var": F.try_divide(F.sum(squares), F.sum("temperatures")),
        "days_seen": F.bit_or("days_seen"),
    }
    rest = [c for c in parts.columns if c not in KEYS]
    merged = [special.get(c, F.sum(c)).alias(c) for c in rest]
    return parts.withColumn("_overall", overall).groupBy(*KEYS).agg(*merged)


def add_to_profile(df: DataFrame, path: str, batch: str, **names) -> None:
    """Profile one batch of observations and add it to the profile below ``path``.

    A batch that is there already is an error, so a repeated run can't count
    its observations twice. ``names`` are those of ``monthly_profile``.
    """
    monthly_profile(df, **names).write.mode("error").parquet(f"{path.rstrip('/')}/batch={batch}")


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    """The merged profile of all batches below ``path``, ready for the roll-ups.

    Measures that some batches lack count for the others only.
    """
    parts = spark.read.option("mergeSchema", True).parquet(path).drop("batch")
    counted = [c for c in parts.columns if c.endswith("_count") or c.startswith("category_")]
    return merged_profile(parts.fillna(0, counted))


def compact_profile(spark: SparkSession, path: str, target: str, batch: str) -> None:
    """Write the merged profile as the only batch below ``target``, for fewer rows to merge later."""
    read_profile(spark, path).write.mode("error").parquet(f"{target.rstrip('/')}/batch={batch}")
