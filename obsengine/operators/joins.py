"""Joins that hold at scale: measured broadcasts, and salted shuffles beyond them."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsengine.constants import BAND_TOLERANCE
from obsengine.session import materialize

# Largest side that is broadcast, in measured bytes of its rows.
BROADCAST_LIMIT = 64 * 1024 * 1024
# Parts that a shuffled key is split into, so no task holds a whole hot key.
SALTS = 16
# Bytes of one key that a task should get at most.
PART_BYTES = 256 * 1024 * 1024

_VARIABLE = (T.StringType, T.BinaryType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def _row_bytes(schema: T.StructType) -> Column:
    def width(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, _NESTED):
            column = F.to_json(F.struct(column))
        elif not isinstance(field.dataType, _VARIABLE):
            return F.lit(8)
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16

    return reduce(Column.__add__, map(width, schema.fields), F.lit(16)).cast("long")


def measured_bytes(df: DataFrame) -> int:
    """Bytes of ``df``'s rows, measured by one distributed aggregate over it."""
    return df.select(F.coalesce(F.sum(_row_bytes(df.schema)), F.lit(0))).first()[0]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT, copies: int = 1) -> bool:
    """Whether ``copies`` of every row of ``df`` stay within ``limit`` bytes.

    File and plan estimates can be far below the decoded size, so the rows
    themselves are measured.
    """
    return measured_bytes(df) * copies <= limit


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashable(field.dataType) for field in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _salt(df: DataFrame, salts: int) -> Column:
    # A function of the row alone: a retried task sends each row to the same place.
    names = [field.name for field in df.schema.fields if _hashable(field.dataType)]
    return F.pmod(F.xxhash64(F.lit(0), *(F.col(f"`{name}`") for name in names)), F.lit(salts))


def salts_for(size: int, least: int = SALTS) -> int:
    """Parts for keys of a side of ``size`` bytes: a key that is all of it still fits in tasks."""
    return max(least, -(-size // PART_BYTES))


def _every_salt(salts: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))


def _check_names(left: DataFrame, right: DataFrame) -> None:
    shared = set(left.columns) & set(right.columns)
    if shared:
        raise ValueError(f"rename the shared columns before joining: {sorted(shared)}")


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    how: str = "left",
    broadcast_limit: int = BROADCAST_LIMIT,
    salts: int = SALTS,
) -> DataFrame:
    """Equi-join of a large ``left`` with ``right``; null keys never match.

    A ``right`` within the measured limit is broadcast, and ``left`` does not
    move. Beyond it both sides shuffle, with each left key spread over
    ``salts`` parts and ``right`` repeated for each part.
    """
    return _keyed_join(left, right, keys, how, broadcast_limit, salts)[0]


def _keyed_join(left, right, keys, how, broadcast_limit, salts) -> tuple[DataFrame, bool]:
    """The joined rows, and whether ``left`` moved for them."""
    _check_left_join(how)
    _check_names(left, right)
    condition = [F.col(a) == F.col(b) for a, b in keys]
    if fits_broadcast(right, broadcast_limit):
        return left.join(F.broadcast(right), condition, how), False
    salts = salts_for(measured_bytes(left), salts)
    salted = left.withColumn("_left_salt", _salt(left, salts))
    repeated = right.withColumn("_right_salt", _every_salt(salts))
    condition.append(F.col("_left_salt") == F.col("_right_salt"))
    return salted.join(repeated, condition, how).drop("_left_salt", "_right_salt"), True


def _check_left_join(how: str) -> None:
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")


def join_alerts(df: DataFrame, alerts: DataFrame, **options) -> DataFrame:
    """Left join of located rows with the alerts of their city."""
    return keyed_join(df, alerts, [("city_name", "alert_city")], **options)


def within_band(pairs: Sequence[tuple[str, str]], tolerance: float) -> Column:
    """The exact band predicate: every pair differs by strictly less than ``tolerance``."""
    return reduce(Column.__and__, (F.abs(F.col(a) - F.col(b)) < tolerance for a, b in pairs))


def _axis(name: str, width: float) -> tuple[Column, Column, Column]:
    """Kind and cell of a coordinate, and whether its quotient may be off by one.

    From ``width * 2**53`` on, neighbouring doubles lie further apart than the
    tolerance, so only equal values match and the value is its own cell. NaN
    and infinite coordinates are within no band: their cell is null.
    """
    value = F.col(name)
    size = F.abs(value)
    finite = size < F.lit(float("inf"))
    far = size >= F.lit(width * 2.0**53)
    kind = F.when(finite, far.cast("int"))
    cell = F.when(finite & far, value).when(finite, F.floor(value / F.lit(width)).cast("double"))
    return kind, cell, size >= F.lit(width * 2.0**50)


def _with_cells(df: DataFrame, names: Sequence[str], width: float) -> DataFrame:
    columns = {}
    for i, name in enumerate(names):
        columns[f"_kind_{i}"], columns[f"_cell_{i}"], _ = _axis(name, width)
    return df.withColumns(columns)


def _with_neighbours(df: DataFrame, names: Sequence[str], width: float) -> DataFrame:
    """``df`` without rows that can't match, repeated for the cells next to each row's own."""
    for i, name in enumerate(names):
        kind, cell, rough = _axis(name, width)
        near = F.when(kind == 1, F.array(cell)).when(
            rough, F.array(*(cell + k for k in range(-2, 3)))
        )
        near = near.otherwise(F.array(*(cell + k for k in range(-1, 2))))
        df = df.filter(kind.isNotNull()).withColumns(
            {f"_near_kind_{i}": kind, f"_near_{i}": F.explode(near)}
        )
    return df


def band_join(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[str, str]],
    tolerance: float = BAND_TOLERANCE,
    how: str = "left",
    points: DataFrame | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
    salts: int = SALTS,
) -> DataFrame:
    """Join rows whose coordinates differ by less than ``tolerance`` on every axis.

    Both sides are laid on a grid of cells twice the tolerance wide, so a match
    is always in the same or a neighbouring cell: ``right`` is repeated for its
    neighbours and the join is an equi-join on the cell, with the exact
    predicate as its residual. A pair meets in one cell only. Coordinates too
    large for cells, next to the tolerance, match where they are equal.

    * ``right`` within the measured limit: its cells are broadcast and ``left``
      does not move.
    * Beyond it: only the distinct coordinates of ``left`` are matched, which
      folds a hot place into one row and leaves the wide rows where they are.
      The matches, stored once, are then joined to ``left`` on the coordinates
      by :func:`keyed_join`.

    ``points`` may name a cheaper frame that holds all coordinates of ``left``.
    Coordinates are finite doubles; null, NaN and infinite ones match nothing.
    """
    return band_join_moved(left, right, pairs, tolerance, how, points, broadcast_limit, salts)[0]


def band_join_moved(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[str, str]],
    tolerance: float = BAND_TOLERANCE,
    how: str = "left",
    points: DataFrame | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
    salts: int = SALTS,
) -> tuple[DataFrame, bool]:
    """The rows of :func:`band_join`, and whether ``left`` was shuffled for them."""
    _check_left_join(how)
    _check_names(left, right)
    left_names, right_names = zip(*pairs)
    width = 2 * tolerance
    near = within_band(pairs, tolerance)
    same_cell = [
        F.col(a) == F.col(b)
        for i in range(len(pairs))
        for a, b in ((f"_kind_{i}", f"_near_kind_{i}"), (f"_cell_{i}", f"_near_{i}"))
    ]
    kinds = ("_kind", "_cell", "_near_kind", "_near")
    helpers = [f"{kind}_{i}" for i in range(len(pairs)) for kind in kinds]
    cells = _with_neighbours(right, right_names, width)

    if fits_broadcast(cells, broadcast_limit):
        joined = _with_cells(left, left_names, width).join(
            F.broadcast(cells), [*same_cell, near], how
        )
        return joined.drop(*helpers), False

    places = (left if points is None else points).select(*left_names).distinct()
    places = _with_cells(places, left_names, width).withColumn("_left_salt", _every_salt(salts))
    spread = cells.withColumn("_right_salt", _salt(right, salts))
    matches = (
        places.join(
            spread, [*same_cell, F.col("_left_salt") == F.col("_right_salt"), near], "inner"
        )
        .drop(*helpers, "_left_salt", "_right_salt")
        .withColumnsRenamed({name: f"_at_{name}" for name in left_names})
    )
    matches = materialize(matches, "band-matches")
    at = [(name, f"_at_{name}") for name in left_names]
    joined, moved = _keyed_join(left, matches, at, how, broadcast_limit, salts)
    return joined.drop(*(b for _, b in at)), moved
