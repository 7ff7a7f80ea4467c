"""Rankings of places."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsengine.operators.aggregates import place_averages
from obsengine.session import materialize

# Most rows that one task numbers by itself.
SINGLE_TASK_ROWS = 1_000_000

# monotonically_increasing_id puts the partition above this many bits.
_POSITION_BITS = 33


def number_rows(df: DataFrame, name: str, order: Sequence[Column]) -> DataFrame:
    """Add ``name``: 1-based position in the global ``order``, without a single-task window.

    The rows are range-partitioned and sorted, their partition and position
    are stored with them, and each partition's offset is the row count of the
    partitions before it. Offsets are one row per partition.
    """
    placed = materialize(
        df.orderBy(*order).withColumn("_position", F.monotonically_increasing_id()), "ranked"
    ).withColumn("_part", F.shiftright("_position", _POSITION_BITS))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_part").alias("_of_part"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
    )
    position = F.col("_position").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), F.col("_part") == F.col("_of_part"))
        .withColumn(name, F.col("_offset") + position + 1)
        .drop("_position", "_part", "_of_part", "_offset")
    )


def rank_averages(averages: DataFrame, single_task_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """Rank places by mean temperature and by mean humidity, highest first.

    Equal means rank by place name. A null place takes its position and is
    then left out, as a join of the two rankings would leave it.
    """
    ranks = {"temp_rank": "avg_temperature", "humidity_rank": "avg_humidity"}
    averages = materialize(averages, "place-averages")
    orders = {name: (F.desc(measure), F.asc("city")) for name, measure in ranks.items()}
    if averages.count() <= single_task_rows:
        averages = averages.withColumns(
            {name: F.row_number().over(Window.orderBy(*order)) for name, order in orders.items()}
        )
    else:
        for name, order in orders.items():
            averages = number_rows(averages, name, order)
    return averages.filter(F.col("city").isNotNull()).select(
        "city",
        "avg_temperature",
        F.col("temp_rank").cast("long").alias("temp_rank"),
        "avg_humidity",
        F.col("humidity_rank").cast("long").alias("humidity_rank"),
    )


def city_rankings(df: DataFrame, single_task_rows: int = SINGLE_TASK_ROWS, **names) -> DataFrame:
    """:func:`rank_averages` of the places of ``df``, read once for both rankings."""
    return rank_averages(place_averages(df, **names), single_task_rows)
