"""All descriptive tables of a frame of observations, from one pass over it."""

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsengine.operators import aggregates as agg
from obsengine.operators.rankings import rank_averages
from obsengine.plans.reports import execution_summary
from obsengine.session import materialize
from obsengine.sources.writers import save_results

# Sort columns of the tables, in the order in which they are reported.
TABLE_ORDER = {
    "summary_statistics": ("city",),
    "monthly_temperature_trends": ("city", "year", "month"),
    "extreme_temperatures": ("city",),
    "temperature_distribution": ("city", "temp_category"),
    "humidity_analysis": ("city",),
    "city_rankings": ("temp_rank",),
}


def descriptive_tables(
    df: DataFrame,
    city: str = "city",
    date: str = "date",
    temperature: str = "temperature",
    measures: Mapping[str, str] = agg.MEASURES,
) -> dict[str, DataFrame]:
    """The descriptive tables by name.

    All but the humidity quartiles are rolled up from one stored profile per
    place and month, so the observations are aggregated once. Frames without
    humidity, such as trusted rows, lack its quartiles, and their ranking by
    humidity is null.
    """
    profile = agg.monthly_profile(df, city, date, temperature, measures)
    profile = materialize(profile, "monthly-profile")
    tables = {
        "summary_statistics": agg.summary_from_profile(profile),
        "monthly_temperature_trends": agg.trends_from_profile(profile),
        "extreme_temperatures": agg.extremes_from_profile(profile),
        "temperature_distribution": agg.distribution_from_profile(profile),
    }
    humidity = measures.get("humidity")
    if humidity in df.columns:
        tables["humidity_analysis"] = agg.humidity_analysis(df, city, humidity)
    rankings = rank_averages(agg.averages_from_profile(profile))
    if humidity not in df.columns:
        rankings = rankings.withColumn("humidity_rank", F.lit(None).cast("long"))
    tables["city_rankings"] = rankings
    return tables


class RunManifest(NamedTuple):
    """What a run produced."""

    output_location: str
    analyses_generated: int
    total_records_processed: int
    skipped: tuple[str, ...] = ()


def descriptive_run(df: DataFrame, root: str | None = None, **names) -> dict[str, DataFrame]:
    """The descriptive tables and their ``execution_summary``; written if ``root`` is given."""
    tables = descriptive_tables(df, **names)
    tables = {name: materialize(table, name) for name, table in tables.items()}
    tables["execution_summary"] = materialize(execution_summary(tables), "execution-summary")
    if root is not None:
        save_results(tables, root, TABLE_ORDER, stored=True)
    return tables


def manifest(tables: dict[str, DataFrame], root: str) -> RunManifest:
    """Counts of a finished run; its rows are added up from the per-place totals."""
    total = tables["summary_statistics"].groupBy().sum("total_observations").first()[0]
    skipped = tuple(name for name in TABLE_ORDER if name not in tables)
    return RunManifest(root, len(tables), total or 0, skipped)
