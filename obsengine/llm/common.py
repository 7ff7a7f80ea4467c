"""Helpers that several operators of this subpackage share."""

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsengine.session import materialize

#: Characters that separate words: the space and U+0009 to U+000D.
SPACES = " \t\n\x0b\f\r"
#: One run of them, for Spark's regular expressions.
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def field(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots and quotes included."""
    return df["`" + name.replace("`", "``") + "`"]


def whole_row(df: DataFrame, alias: str = "row") -> Column:
    """All columns as one struct, so that working columns can't clash with them."""
    return F.struct(*(field(df, c) for c in df.columns)).alias(alias)


def words_of(text: Column) -> Column:
    """Array of the maximal runs without :data:`SPACES`; empty for null."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE_RUN)
    return F.filter(parts, lambda w: w != "")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, so that a task holds the results of few rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Jobs run inside move at most so many rows to Python at once.

    For rows that carry whole texts or sets: both ends hold a batch, Spark's
    buffers up to twice its size. The session's own number is set again after.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def free_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished jobs.

    Spark deletes them when the driver's collector meets the plans of these
    jobs, which is asked to run. Files that a live plan needs stay.
    """
    spark.sparkContext._jvm.System.gc()


def discard(*tables: DataFrame) -> None:
    """Delete stored scratch tables that nothing reads any more, and free finished shuffles.

    Only for tables of ``materialize`` whose results are stored elsewhere; what
    still reads one fails.
    """
    for table in tables:
        files = table.inputFiles()
        if files:
            context = table.sparkSession.sparkContext
            folder = context._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
    if tables:
        free_shuffles(tables[0].sparkSession)


BITMAP_BITS = 23


def _slot(value: Column, bits: int) -> tuple[Column, Column]:
    slot = F.pmod(F.xxhash64(value), F.lit(1 << bits))
    return F.shiftright(slot, 5).cast("int"), slot.bitwiseAND(F.lit(31)).cast("int")


def bitmap(keys: DataFrame, key: str, bits: int = BITMAP_BITS) -> DataFrame:
    """A bitmap of the hashed keys, as at most ``2**(bits - 5)`` rows (cell, mask).

    Its size has this bound whatever the number of keys, so it may be broadcast.
    It only spares rows a later exact join: keys may be let through by chance,
    never left out.
    """
    cell, bit = _slot(F.col(key), bits)
    return (
        keys.select(cell.alias("_cell"), F.call_function("shiftleft", F.lit(1), bit).alias("_mask"))
        .groupBy("_cell")
        .agg(F.bit_or("_mask").alias("_mask"))
    )


def possibly(df: DataFrame, key: Column, marks: DataFrame, bits: int = BITMAP_BITS) -> DataFrame:
    """``df`` with a boolean column ``_possible``: whether the bitmap may hold the row's key."""
    cell, bit = _slot(key, bits)
    joined = df.withColumns({"_cell": cell, "_bit": bit}).join(F.broadcast(marks), "_cell", "left")
    mark = F.coalesce(F.call_function("shiftrightunsigned", F.col("_mask"), F.col("_bit")).bitwiseAND(F.lit(1)) == 1, F.lit(False))
    return joined.withColumn("_possible", mark).drop("_cell", "_bit", "_mask")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Connected components: (node, root), the root being the smallest node.

    ``nodes`` has a column node without repeats, ``links`` columns a and b.
    Labels spread along links and then jump to the label of their label, so
    the number of rounds is about the logarithm of the longest chain. Every
    round is a few joins on node, stored, and no round gathers a component.
    """
    both = materialize(
        links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links"
    )
    linked = both.select(F.col("a").alias("node")).distinct()
    labels = materialize(linked.select("node", F.col("node").alias("root")), "labels")
    while True:
        heard = (
            both.join(labels.withColumnRenamed("node", "a"), "a")
            .groupBy(F.col("b").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        told = labels.join(heard, "node").select(
            "node", "root", F.least("root", "near").alias("next")
        )
        hops = labels.select(F.col("node").alias("next"), F.col("root").alias("hop"))
        stepped = materialize(
            told.join(hops, "next").select("node", F.least("next", "hop").alias("new"), "root"),
            "labels",
        )
        if stepped.filter(F.col("new") != F.col("root")).isEmpty():
            break
        labels = stepped.select("node", F.col("new").alias("root"))
    alone = nodes.select("node").join(linked, "node", "left_anti")
    return labels.select("node", "root").union(alone.select("node", F.col("node").alias("root")))
