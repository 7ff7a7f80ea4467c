"""Observation-shaped views of the star-schema test tables.

Each text runs unchanged in Spark and in other SQL engines once the table
names in braces are filled in.
"""

from pyspark.sql import DataFrame, SparkSession

_PLACED = """FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey
              JOIN {nation} ON s_nationkey = n_nationkey"""

VIEWS = {
    "obs_point": f"""
SELECT n_name AS city, CAST(l_shipdate AS DATE) AS date,
       l_quantity AS temperature,
       l_discount * CAST(1000 AS DOUBLE) AS humidity,
       l_extendedprice / CAST(100 AS DOUBLE) AS pressure,
       l_tax * CAST(100 AS DOUBLE) AS wind_speed
{_PLACED}""",
    "obs_daily": f"""
SELECT n_name AS city,
       n_nationkey * CAST(0.3 AS DOUBLE) AS latitude,
       n_nationkey * CAST(-0.3 AS DOUBLE) AS longitude,
       CAST(l_shipdate AS DATE) AS date,
       MAX(l_quantity) AS temp_max,
       MIN(l_quantity) - MAX(l_discount) * CAST(100 AS DOUBLE) AS temp_min,
       MAX(l_tax * CAST(250 AS DOUBLE)) AS precipitation,
       MAX(l_discount * CAST(200 AS DOUBLE)) AS windspeed_max
{_PLACED}
GROUP BY n_name, n_nationkey, CAST(l_shipdate AS DATE)""",
    "cities": """
SELECT n_name AS name,
       CONCAT('R', CAST(n_regionkey AS VARCHAR(10))) AS department,
       n_nationkey * CAST(0.3 AS DOUBLE) + CAST(0.02 AS DOUBLE) AS latitude,
       n_nationkey * CAST(-0.3 AS DOUBLE) AS longitude,
       NULLIF(n_nationkey * 1000, 5000) AS population
FROM {nation} WHERE n_nationkey % 8 <> 7""",
    "stations": """
SELECT s_name AS station_name, n_name AS city,
       s_nationkey * CAST(0.3 AS DOUBLE) + (s_suppkey % 7) * CAST(0.03 AS DOUBLE) AS latitude,
       s_nationkey * CAST(-0.3 AS DOUBLE) - (s_suppkey % 5) * CAST(0.03 AS DOUBLE) AS longitude,
       CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE s_acctbal END AS altitude,
       CASE WHEN s_suppkey % 4 = 0 THEN 'inactive' ELSE 'active' END AS status
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "alerts": """
SELECT n_name AS city, 'temperatura' AS alert_type, 'high' AS severity,
       CAST(30 + n_regionkey AS DOUBLE) AS threshold_value,
       n_nationkey % 2 = 0 AS is_active
FROM {nation} WHERE n_nationkey % 3 <> 0
UNION ALL
SELECT n_name, 'lluvia', 'low', CAST(5 + n_regionkey AS DOUBLE), n_nationkey % 2 = 1
FROM {nation} WHERE n_nationkey % 4 <> 1""",
}

TABLES = ("nation", "supplier", "lineitem")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One view as a DataFrame over the Parquet tables in ``sf_dir``."""
    text = VIEWS[name]
    frames = {
        table: spark.read.parquet(f"{sf_dir}/{table}.parquet")
        for table in TABLES
        if "{" + table + "}" in text
    }
    return spark.sql(text, **frames)


def with_views(query: str) -> str:
    """``query`` preceded by the views it may name, for an engine that has the tables."""
    tables = {table: table for table in TABLES}
    views = ",\n".join(
        f"{name} AS ({text.format(**tables)})" for name, text in VIEWS.items() if name in query
    )
    if not views:
        return query
    if query.startswith("WITH "):
        return f"WITH {views},\n{query.removeprefix('WITH ')}"
    return f"WITH {views}\n{query}"
