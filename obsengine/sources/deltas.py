"""Snapshots as deltas: what changed since the last stamp, and tables rebuilt from deltas.

Each stamp stores the rows that are new or changed, the keys that are gone, and
a digest per row to compare the next stamp with. A table that hardly changes
costs its digests, not its rows.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from obsengine.session import materialize

#: What a delta row says of its key.
PUT, GONE = "put", "gone"


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def row_digest(df: DataFrame) -> Column:
    """A 128-bit digest of all columns of a row, nulls told from empty texts."""
    whole = F.struct(*(_quoted(c) for c in df.columns))
    return F.md5(F.to_json(whole, {"ignoreNullFields": "false"}))


def _folders(root: str, name: str, stamp: str | None = None) -> tuple[str, str]:
    """Where the deltas and the digests of a table are, of all stamps or of one."""
    end = "" if stamp is None else f"/stamp={stamp}"
    return tuple(f"{root.rstrip('/')}/{kind}/{name}{end}" for kind in ("deltas", "digests"))


def write_delta(
    df: DataFrame, root: str, name: str, keys: Sequence[str], stamp: str, previous: str | None = None
) -> dict[str, int]:
    """Store what changed in a table since the stamp ``previous`` (None: everything is new).

    ``keys`` name a row; null is a key like any other, and a key that repeats
    is an error, as is a stamp that is there already. Returns how many rows
    were put and how many are gone. Rows meet the digests of the last stamp by
    one join on the keys, and only digests of that stamp are read.
    """
    deltas, digests = _folders(root, name, stamp)
    key = F.struct(*(_quoted(k) for k in keys)).alias("key")
    row = F.struct(*(_quoted(c) for c in df.columns)).alias("row")
    now = materialize(df.select(key, row_digest(df).alias("digest"), row), f"{name}-{stamp}")
    if not now.groupBy("key").count().filter("count > 1").isEmpty():
        raise ValueError(f"rows of {name} share a key: {list(keys)}")
    if previous is None:
        changed = now.select("key", F.lit(PUT).alias("op"), "row")
    else:
        before = df.sparkSession.read.parquet(_folders(root, name, previous)[1])
        old = before.select(F.col("key").alias("old_key"), F.col("digest").alias("old_digest"))
        equal = reduce(Column.__and__, (F.col(f"key.`{k}`").eqNullSafe(F.col(f"old_key.`{k}`")) for k in keys))
        met = now.join(old, equal, "full").filter(~F.col("digest").eqNullSafe(F.col("old_digest")))
        here = F.col("digest").isNotNull()
        changed = met.select(
            F.coalesce(F.when(here, F.col("key")), F.col("old_key")).alias("key"),
            F.when(here, PUT).otherwise(GONE).alias("op"), "row",
        )
    seen = Observation()
    counts = (F.count_if(F.col("op") == op).alias(op) for op in (PUT, GONE))
    changed.observe(seen, *counts).write.mode("error").parquet(deltas)
    # Digests last: a stamp without them is not compared with.
    now.select("key", "digest").write.mode("error").parquet(digests)
    return dict(seen.get)


def read_at(spark: SparkSession, root: str, name: str, stamp: str) -> DataFrame:
    """The rows of a table as they were at a stamp: its deltas applied in the order of their stamps.

    Stamps are compared as text. The last word on each key counts, which is
    found by one aggregation and not by applying deltas one after the other.
    """
    deltas = spark.read.parquet(_folders(root, name)[0])
    # A folder's name can look like a number.
    file = F.col("_metadata.file_path")
    of = F.regexp_extract(file, r"/stamp=([^/]*)/[^/]*$", 1)
    told = deltas.select("key", "op", "row", of.alias("at")).filter(F.col("at") <= stamp)
    last = told.groupBy("key").agg(F.max_by(F.struct("op", "row"), "at").alias("last"))
    return last.filter(F.col("last.op") == PUT).select("last.row.*")
