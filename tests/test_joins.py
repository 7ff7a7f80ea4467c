"""Band and keyed joins against brute force, on both of their strategies."""

import itertools
import random

import pytest
from conftest import multiset
from pyspark.sql import functions as F

from obsengine.operators import joins

PAIRS = [("x", "u"), ("y", "v")]
NAN, INF = float("nan"), float("inf")
STRATEGIES = {"broadcast": joins.BROADCAST_LIMIT, "points": 0}


def brute(left, right, tolerance, how):
    rows = []
    for a in left:
        found = [
            b
            for b in right
            if None not in (a[1], a[2], b[1], b[2])
            and abs(a[1] - b[1]) < tolerance
            and abs(a[2] - b[2]) < tolerance
        ]
        rows += [(*a, *b) for b in found]
        if not found and how == "left":
            rows.append((*a, None, None, None))
    return sorted(repr(row) for row in rows)


def coordinates(rng, count):
    special = [None, NAN, INF, -INF, 0.0, -0.0, 0.1, -0.1, 0.2, 0.3, 6.25, 6.35]
    pool = [*special, *(round(rng.uniform(-1, 1), 2) for _ in range(30))]
    return [(i, rng.choice(pool), rng.choice(pool)) for i in range(count)]


@pytest.mark.parametrize("limit", STRATEGIES.values(), ids=STRATEGIES)
@pytest.mark.parametrize(("how", "seed"), list(itertools.product(["left", "inner"], [1, 2])))
def test_band_join_equals_brute_force(spark, limit, how, seed):
    rng = random.Random(seed)
    left, right = coordinates(rng, 400), coordinates(rng, 120)
    a = spark.createDataFrame(left, "i long, x double, y double").repartition(3)
    b = spark.createDataFrame(right, "j long, u double, v double").repartition(2)
    joined = joins.band_join(a, b, PAIRS, how=how, broadcast_limit=limit)
    assert joined.columns == ["i", "x", "y", "j", "u", "v"]
    assert sorted(repr(tuple(row)) for row in joined.collect()) == brute(left, right, 0.1, how)


@pytest.mark.parametrize("limit", STRATEGIES.values(), ids=STRATEGIES)
def test_band_is_strict_on_doubles(frame, limit):
    a = frame("x double, y double", (6.25, 0.0), (0.5, 0.0))
    b = frame("u double, v double", (6.35, 0.0), (0.5, 0.1), (0.5, 0.0999), (0.4, 0.0))
    joined = joins.band_join(a, b, PAIRS, how="inner", broadcast_limit=limit)
    # 6.35 - 6.25 is below 0.1 in doubles, and so is 0.5 - 0.4.
    assert sorted((r.x, r.u, r.v) for r in joined.collect()) == sorted(
        (x, u, v)
        for x in (6.25, 0.5)
        for u, v in ((6.35, 0.0), (0.5, 0.1), (0.5, 0.0999), (0.4, 0.0))
        if abs(x - u) < 0.1 and abs(v) < 0.1
    )


@pytest.mark.parametrize("tolerance", [1e-15, 1e-14, 1e-9, 0.1, 10.0])
@pytest.mark.parametrize("most", [joins.BROADCAST_LIMIT, 0])
def test_bands_at_any_magnitude(spark, tolerance, most):
    import itertools
    import math

    sizes = [0.0, 1e-15, 80.0, 170.0, 1e6, 1e15, 1e18, 1e300, tolerance * 2.0**51, tolerance * 2.0**54]
    near = sorted({s * x for v in sizes for s in (1, -1) for x in (v, math.nextafter(v, 1e301), v + tolerance / 2, v + tolerance)})
    near += [math.inf, -math.inf, math.nan, None]
    a = spark.createDataFrame([(i, v) for i, v in enumerate(near)], "i int, x double")
    b = a.withColumnsRenamed({"i": "j", "x": "u"})
    got = joins.band_join(a, b, [("x", "u")], tolerance, "inner", broadcast_limit=most)
    finite = [(i, v) for i, v in enumerate(near) if v is not None and math.isfinite(v)]
    expected = {(i, j) for (i, v), (j, u) in itertools.product(finite, finite) if abs(v - u) < tolerance}
    rows = [(r.i, r.j) for r in got.collect()]
    assert sorted(rows) == sorted(expected)


@pytest.mark.parametrize("most", [joins.BROADCAST_LIMIT, 0])
def test_maps_pass_on_both_branches(spark, most):
    a = spark.createDataFrame([("k", {"x": 1}), ("l", None)], "k string, m map<string,int>")
    b = a.withColumnsRenamed({"k": "key", "m": "map"})
    assert joins.keyed_join(a, b, [("k", "key")], broadcast_limit=most).count() == 2


@pytest.mark.parametrize("limit", STRATEGIES.values(), ids=STRATEGIES)
def test_duplicate_rows_multiply(frame, limit):
    a = frame("i int, x double, y double", (1, 0.0, 0.0), (1, 0.0, 0.0), (2, 5.0, 5.0))
    b = frame("u double, v double", (0.0, 0.0), (0.0, 0.0), (0.05, 0.05))
    joined = joins.band_join(a, b, PAIRS, broadcast_limit=limit)
    assert joined.groupBy("i").count().orderBy("i").collect() == [(1, 6), (2, 1)]


def test_band_join_of_one_axis_and_other_tolerance(frame):
    a = frame("x double", (1.0,), (2.0,))
    b = frame("u double", (1.9,), (4.0,))
    joined = joins.band_join(a, b, [("x", "u")], tolerance=1.0)
    assert sorted(joined.collect()) == [(1.0, 1.9), (2.0, 1.9)]


def test_points_may_come_from_elsewhere(frame):
    a = frame("i int, x double, y double", (1, 0.0, 0.0), (2, 9.0, 9.0))
    b = frame("u double, v double", (0.01, 0.0))
    points = frame("x double, y double", (0.0, 0.0), (9.0, 9.0), (3.0, 3.0))
    joined = joins.band_join(a, b, PAIRS, points=points, broadcast_limit=0)
    assert sorted((r.i, r.u) for r in joined.collect()) == [(1, 0.01), (2, None)]


@pytest.mark.parametrize("limit", STRATEGIES.values(), ids=STRATEGIES)
def test_plans_have_no_nested_loop(spark, plan, limit):
    a = spark.range(200).selectExpr("id", "id * 0.01D as x", "id * 0.01D as y")
    b = spark.range(50).selectExpr("id as j", "id * 0.04D as u", "id * 0.04D as v")
    text = plan(joins.band_join(a, b, PAIRS, broadcast_limit=limit))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_broadcast_strategy_leaves_the_left_side_in_place(spark, plan):
    a = spark.range(200).selectExpr("id", "id * 0.01D as x", "id * 0.01D as y")
    b = spark.range(50).selectExpr("id as j", "id * 0.04D as u", "id * 0.04D as v")
    text = plan(joins.band_join(a, b, PAIRS))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_shared_names_are_refused(frame):
    a = frame("x double, y double", (0.0, 0.0))
    with pytest.raises(ValueError, match="shared"):
        joins.band_join(a, a, [("x", "x"), ("y", "y")])
    with pytest.raises(ValueError, match="how"):
        joins.band_join(a, frame("u double, v double", (0.0, 0.0)), PAIRS, how="full")


@pytest.mark.parametrize("limit", [joins.BROADCAST_LIMIT, 0], ids=["broadcast", "salted"])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_keyed_join_with_a_hot_key(spark, limit, how):
    # Half of the rows share one key, and all of these are copies of one row.
    left = spark.range(3000).selectExpr(
        "if(id < 1500, 0, id) as i", "if(id < 1500, 'hot', if(id % 7 = 0, null, concat('k', id % 50))) as k"
    )
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), (None, 3), *((f"k{n}", n) for n in range(40))], "l string, n int"
    )
    expected = left.join(right, F.col("k") == F.col("l"), how)
    got = joins.keyed_join(left, right, [("k", "l")], how, broadcast_limit=limit)
    assert got.columns == expected.columns
    assert multiset(got) == multiset(expected)


def test_salting_spreads_a_hot_key(spark):
    left = spark.range(32_000).selectExpr("id", "'hot' as k")
    right = spark.createDataFrame([("hot", 1)], "l string, n int")
    sides = left.withColumn("salt", joins._salt(left, joins.SALTS))
    assert sides.groupBy("salt").count().count() == joins.SALTS
    assert sides.groupBy("salt").count().agg(F.max("count")).first()[0] < 32_000 / joins.SALTS * 1.2
    assert joins.keyed_join(left, right, [("k", "l")], broadcast_limit=0).count() == 32_000


def test_measured_bytes_follow_the_rows(frame):
    df = frame("a string, b int, c array<int>", ("x" * 1000, 1, [1, 2]), (None, None, None))
    assert 1000 < joins.measured_bytes(df) < 1300
    assert joins.measured_bytes(df.limit(0)) == 0
    assert joins.fits_broadcast(df, 1300) and not joins.fits_broadcast(df, 1300, copies=9)


def test_copies_of_one_row_are_split_at_run_time(spark, plan):
    # Copies share a salt, so the adaptive skew join has to split their partition.
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        # Wide enough that shuffle compression does not fold the copies.
        wide = random.Random(0).randbytes(100_000).hex()
        left = spark.range(0, 900, 1, 8).select(
            F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("i"),
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"),
            F.when(F.col("id") % 3 == 0, F.lit(wide)).alias("payload"),
        )
        right = spark.range(1000).selectExpr("if(id = 0, 'hot', concat('k', id)) as l", "id as n")
        joined = joins.keyed_join(left, right, [("k", "l")], broadcast_limit=0)
        assert "skew=true" in plan(joined)
        assert joined.count() == 900
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
