"""Enrichment: observations with their places, stations, alerts and quality."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from obsengine import constants as C
from obsengine import schemas
from obsengine.functions import columns as fn
from obsengine.operators.joins import BROADCAST_LIMIT, band_join_moved, keyed_join
from obsengine.session import materialize

CITY_BAND = [("lat", "city_lat"), ("lon", "city_lon")]
STATION_BAND = [("lat", "station_lat"), ("lon", "station_lon")]


def enrich(
    observations: DataFrame,
    cities: DataFrame,
    stations: DataFrame,
    alerts: DataFrame,
    tolerance: float = C.BAND_TOLERANCE,
    broadcast_limit: int = BROADCAST_LIMIT,
    by_date: bool = False,
) -> DataFrame:
    """Trusted rows from the four raw inputs, in their source column names.

    Alerts depend on the city alone, so they are joined to the cities first:
    the observations pass through two joins, not three, and are never shuffled
    by city. Rows multiply by the cities, stations and alerts they match.

    With ``by_date`` the observations are stored and dealt by date before they
    multiply: few of them do not meet in few tasks, and the rows of a date come
    from one task or a few neighbouring ones, so they can be written as they are.
    """
    facts = fn.conform(observations, fn.OBSERVATION_NAMES)
    if by_date:
        facts = _dealt_by_date(facts)
    places = fn.conform(cities, fn.CITY_NAMES)
    rules = fn.conform(alerts, fn.ALERT_NAMES)
    watched = keyed_join(
        places, rules, [("city_name", "alert_city")], broadcast_limit=broadcast_limit
    )
    # Measured and joined: computed once.
    watched = materialize(watched, "watched")
    sites = fn.conform(stations, fn.STATION_NAMES)

    options = {"tolerance": tolerance, "points": facts, "broadcast_limit": broadcast_limit}
    located, moved = band_join_moved(facts, watched, CITY_BAND, **options)
    rows, moved_again = band_join_moved(located, sites, STATION_BAND, **options)
    if by_date and (moved or moved_again):
        rows = rows.hint("rebalance", "date")
    return (
        rows.transform(fn.with_temp_avg)
        .transform(fn.with_alert_triggered)
        .transform(fn.with_quality_score)
        .select(*schemas.TRUSTED.fieldNames())
    )


def _dealt_by_date(facts: DataFrame) -> DataFrame:
    """Stored observations, dealt by date and, within a date, by a hash of the row; sorted by date within tasks.

    The order holds through broadcast joins, so a writer by date need not sort
    the rows again. The optimizer drops a sort right below a join; not one
    whose rows are observed.
    """
    stored = materialize(facts, "observations")
    parts = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored.repartitionByRange(parts, "date", F.xxhash64(*stored.columns)).sortWithinPartitions("date")
    return dealt.observe(Observation(), F.count(F.lit(1)).alias("n"))
