"""Fixed values that results depend on."""

# Coordinate band, in degrees, strict on both axes.
BAND_TOLERANCE = 0.1

# Alert types with a firing rule, and the measure each one watches.
ALERT_MEASURES = {"temperatura": "temp_max", "lluvia": "precipitation"}

# Quality score of a row with and without its place or station.
SCORE_PARTIAL = 0.5
SCORE_COMPLETE = 1.0

# Temperature categories; a value below a cutoff takes its label.
TEMPERATURE_CUTOFFS = (15, 25, 30)
TEMPERATURE_LABELS = ("Frío", "Templado", "Cálido", "Muy Cálido")

# Cutoffs of the 0/1 flags, all strict.
HIGH_PRECIPITATION = 10
EXTREME_TEMPERATURE = 35
RAINY_CLASS = 5

# Monthly summary categories.
HOT_ABOVE, COLD_BELOW = 30, 15
RAIN_HIGH_ABOVE, RAIN_MEDIUM_ABOVE = 200, 100
SUMMARY_FROM_YEAR = 2023

# Model settings.
FOREST_TREES, FOREST_DEPTH = 50, 10
CLUSTERS = 4
TRAIN_SHARE = 0.8
SPLIT_SEED = 42
TEMPERATURE_FEATURES = (
    "temp_min", "precipitation", "day_of_year", "month", "altitude", "population",
)
PRECIPITATION_FEATURES = ("temp_max", "temp_min", "temp_range", "day_of_year", "month")
CLUSTER_FEATURES = ("temp_avg", "temp_range", "precipitation")

# Accuracy of approximate quartiles (rank error is 1 / accuracy).
QUARTILE_ACCURACY = 1_000_000
