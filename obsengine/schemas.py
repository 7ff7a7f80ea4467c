"""Declared schemas: nothing is inferred from data."""

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _schema(columns: str) -> T.StructType:
    """Schema from ``"name type, ..."``; unlike ``fromDDL`` it needs no session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Raw files carry dates as text, and whole-number measures as JSON integers.
RAW_OBSERVATION = _schema(
    "city string, latitude double, longitude double, date string, temp_max double, "
    "temp_min double, precipitation double, windspeed_max double, extraction_timestamp string"
)
API_PAYLOAD = _schema(
    "city string, latitude double, longitude double, extraction_timestamp string"
).add(
    "daily",
    T.StructType()
    .add("time", T.ArrayType(T.StringType()))
    .add("temperature_2m_max", T.ArrayType(T.DoubleType()))
    .add("temperature_2m_min", T.ArrayType(T.DoubleType()))
    .add("precipitation_sum", T.ArrayType(T.DoubleType()))
    .add("windspeed_10m_max", T.ArrayType(T.DoubleType())),
)
CITIES = _schema(
    "name string, department string, latitude double, longitude double, population int"
)
STATIONS = _schema(
    "station_name string, city string, latitude double, longitude double, altitude double, status string"
)
ALERTS = _schema(
    "city string, alert_type string, severity string, threshold_value double, is_active boolean"
)
HISTORICAL_EVENTS = _schema(
    "event_id int, city_id int, event_date date, event_type string, severity string, description string"
)
TRUSTED = _schema(
    "lat double, lon double, temp_max double, temp_min double, precipitation double, "
    "windspeed_max double, weather_city string, "
    "city_name string, department string, city_lat double, city_lon double, population int, "
    "station_name string, station_city string, station_lat double, station_lon double, "
    "altitude double, status string, "
    "alert_city string, alert_type string, severity string, threshold_value double, is_active boolean, "
    "temp_avg double, alert_triggered boolean, data_quality_score double, date date"
)

RESULT_TABLES = {
    "city_temperature_stats": _schema(
        "city string, year int, month int, avg_temp_max double, avg_temp_min double, "
        "total_precipitation double, avg_windspeed double, days_with_rain int, "
        "extreme_temp_max double, extreme_temp_min double"
    ),
    "monthly_patterns": _schema(
        "month int, city string, avg_temperature double, total_precipitation double, "
        "precipitation_days int, temperature_variance double, seasonal_pattern string"
    ),
    "extreme_events": _schema(
        "city string, event_date date, event_type string, temperature_max double, "
        "precipitation double, windspeed_max double, severity_score double, duration_days int"
    ),
    "ml_predictions": _schema(
        "city string, prediction_date date, predicted_temp_max double, predicted_temp_min double, "
        "predicted_precipitation double, confidence_score double, model_version string, "
        "prediction_timestamp timestamp"
    ),
}
GENERIC_TABLE = _schema("data string")
