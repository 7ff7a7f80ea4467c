"""Exact quartiles per place by refining bounded histograms.

Sorting a place to find its quartiles puts all its rows into one task. Here
every round counts a place's values into a few bins, whose edges come from a
sketch, and keeps only the bins that hold the wanted ranks. Edges decide how
fast a round narrows and never what it finds, since bins are counted exactly.
Equal values are folded, so ties narrow at once, and only when no more than
:data:`LIMIT` distinct values of a quartile are left are they put in order.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsengine.operators.joins import fits_broadcast
from obsengine.session import materialize

SHARES = (0.25, 0.5, 0.75)
#: Distinct values of one place and quartile that one task puts in order.
LIMIT = 10_000
#: Share of the rows beside each quartile that the first round keeps.
MARGIN = 0.001
#: Rank error of the edges, and the number of edges in later rounds.
ACCURACY, EDGES = 10_000, 31


def _with(rows: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with the columns of the one row of ``state`` with equal keys, null keys included."""
    named = state.select(*(F.col(c).alias(f"_{c}") if c in keys else F.col(c) for c in state.columns))
    equal = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
    side = F.broadcast(named) if fits_broadcast(named) else named
    return rows.join(side, equal).drop(*(f"_{k}" for k in keys))


def _bin(edges: int) -> Column:
    """The number of edges below ``value``: a bin holds its upper edge."""
    return reduce(Column.__add__, ((F.col("value") > F.col("edges")[i]).cast("int") for i in range(edges)))


def _before(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counted bins with ``before``, the rows in the bins below; a group has few bins."""
    below = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("m").over(below), F.lit(0)))


def _holding(counts: DataFrame, targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of each target the bin that holds its rank, and its rank within the bin."""
    met = _with(_before(counts, keys), targets, keys)
    inside = (F.col("before") < F.col("rank")) & (F.col("rank") <= F.col("before") + F.col("m"))
    return met.filter(inside).withColumn("rank", F.col("rank") - F.col("before")).drop("m", "before")


def _first_round(values: DataFrame, stats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Folded values (city, bin, value, m) of the kept bins, and targets (city, q, bin, rank)."""
    edges = 2 * len(SHARES)
    sketch = stats.select("city", "edges")
    binned = _with(values, sketch, ["city"]).withColumn("bin", _bin(edges))
    counts = materialize(binned.groupBy("city", "bin").agg(F.count("*").alias("m")), "quartile-bins")
    wanted = F.array(*(
        F.struct(F.lit(i).alias("q"), F.greatest(F.lit(1), F.ceil(F.col("n") * share)).cast("long").alias("rank"))
        for i, share in enumerate(SHARES)
    ))
    ranks = stats.filter(F.col("n") > 0).select("city", wanted.alias("wanted"))
    inside = lambda w: (F.col("before") < w["rank"]) & (w["rank"] <= F.col("before") + F.col("m"))
    met = _with(_before(counts, ["city"]), ranks, ["city"]).select(
        "city", "bin", "before", F.inline(F.filter("wanted", inside))
    )
    targets = materialize(
        met.select("city", "q", "bin", (F.col("rank") - F.col("before")).alias("rank")), "quartile-targets"
    )
    bins = targets.groupBy("city").agg(F.collect_set("bin").alias("bins"))  # three at most
    kept = _with(binned, bins, ["city"]).filter(F.array_contains("bins", F.col("bin")))
    return kept.groupBy("city", "bin", "value").agg(F.count("*").alias("m")), targets


def _narrowed(cells: DataFrame) -> DataFrame:
    """The cells (city, q, value, m, rank) of the bin that holds each group's rank, ranked within it."""
    keys = ["city", "q"]
    shares = [(i + 1) / (EDGES + 1) for i in range(EDGES)]
    state = materialize(
        cells.groupBy(*keys).agg(
            F.percentile_approx("value", shares, ACCURACY).alias("edges"), F.first("rank").alias("rank")
        ),
        "quartile-edges",
    )
    binned = _with(cells.drop("rank"), state.drop("rank"), keys).withColumn("bin", _bin(EDGES)).drop("edges")
    counts = binned.groupBy(*keys, "bin").agg(F.sum("m").alias("m"))
    chosen = _holding(counts, state.drop("edges"), keys)
    return _with(binned, chosen, [*keys, "bin"]).drop("bin")


def exact_quartiles(df: DataFrame, city: str = "city", humidity: str = "humidity", limit: int = LIMIT) -> DataFrame:
    """Per place: mean humidity and its exact quartiles, in the columns of ``humidity_analysis``.

    A quartile is the smallest value whose share of the known values reaches
    it, so it is a value that occurs. Null values are not counted; a place
    without known values has nulls. NaN is the greatest value.
    """
    value = F.col(humidity)
    near = [s for share in SHARES for s in (share - MARGIN, share + MARGIN)]
    values = df.select(F.col(city).alias("city"), value.alias("value"))
    stats = materialize(
        values.groupBy("city").agg(
            F.count("value").alias("n"), F.avg("value").alias("avg_humidity"),
            F.percentile_approx("value", near, ACCURACY).alias("edges"),
        ),
        "quartile-stats",
    )
    folded, targets = _first_round(values.filter(F.col("value").isNotNull()), stats)
    folded = materialize(folded, "quartile-values")
    # A value can serve several quartiles, so there are three rows of it at most.
    per_bin = targets.groupBy("city", "bin").agg(F.collect_list(F.struct("q", "rank")).alias("of"))
    cells = _with(folded, per_bin, ["city", "bin"]).select("city", "value", "m", F.inline("of"))
    while True:
        cells = materialize(cells, "quartile-cells")
        largest = cells.groupBy("city", "q").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
        if (largest or 0) <= limit:
            break
        cells = _narrowed(cells)
    through = F.sum("m").over(Window.partitionBy("city", "q").orderBy("value"))
    found = (
        cells.withColumn("through", through).filter(F.col("through") >= F.col("rank"))
        .groupBy("city").agg(*(
            F.min(F.when(F.col("q") == i, F.col("value"))).alias(name)
            for i, name in enumerate(("humidity_q1", "humidity_median", "humidity_q3"))
        ))
    )
    named = found.withColumnRenamed("city", "_city")
    return (
        stats.join(named, F.col("city").eqNullSafe(F.col("_city")), "left")
        .select("city", "avg_humidity", "humidity_q1", "humidity_median", "humidity_q3")
        .orderBy("city")
    )
