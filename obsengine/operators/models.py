"""Forest regression and classification, and clustering, on MLlib.

Enrichment repeats a day once per station and alert, and most copies are equal
in all that a model reads. They are folded to one row with a weight, which
scaling, fitting and scoring use; only scored rows are expanded again. Training
reads its rows several times, so they are stored once as a scratch table of
even parts. A forest sees no more of a feature than one of 32 bins: beyond
``BINNED_ABOVE`` folded rows the bins are cut first and training rows fold by
them, so what a forest keeps in memory does not follow the rows. Seeds are
required: the library's default seeds differ between processes.
"""

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Bucketizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsengine import constants as C
from obsengine.functions import columns as fn
from obsengine.operators.joins import fits_broadcast, measured_bytes
from obsengine.operators.metrics import classification_metrics, regression_metrics
from obsengine.operators.splits import in_training
from obsengine.session import materialize, scratch_path

ROW_KEYS = ("city_name", "date")

# Columns of trusted rows that the models read.
INPUT_NAMES = tuple(
    dict.fromkeys(
        (*ROW_KEYS, *C.TEMPERATURE_FEATURES, *C.PRECIPITATION_FEATURES, *C.CLUSTER_FEATURES, "temp_max", "precipitation")
    )
)

# Bytes of rows that one part of the stored model rows holds at most.
PART_BYTES = 128 * 1024 * 1024

# Folded rows beyond which forests are fitted on rows folded by bins, and those rows in a part at most.
BINNED_ABOVE = 2_000_000
BINNED_ROWS = 100_000

# Bins of a feature: as many as the library's forests have.
BINS = 32

# Copies of a folded row that are made at once.
_COPIES = 10_000


class ModelResult(NamedTuple):
    """Scored rows and a one-row frame of metrics."""

    rows: DataFrame
    metrics: DataFrame


def prepare_ml(df: DataFrame) -> DataFrame:
    """Trusted rows with calendar, temperature and flag columns, complete rows only."""
    return (
        df.transform(fn.with_calendar)
        .transform(fn.with_temp_range)
        .transform(fn.with_temp_avg)
        .transform(fn.with_flags)
        .transform(fn.complete_rows)
    )


def folded_rows(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Distinct rows of the named columns, with ``weight``: how many rows of ``df`` each stands for.

    Nulls are equal to nulls. Copies fold within tasks before they move, so a
    row that is repeated very often costs no task more than a few rows.
    """
    return df.groupBy(*dict.fromkeys(names)).agg(F.count(F.lit(1)).alias("weight"))


def unfolded(df: DataFrame) -> DataFrame:
    """Each row ``weight`` times, without that column: the inverse of :func:`folded_rows`.

    Copies are made in blocks, so a large weight needs no large array.
    """
    last = F.call_function("div", F.col("weight") - 1, F.lit(_COPIES))
    blocks = df.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    size = F.least(F.lit(_COPIES), F.col("weight") - F.col("_block") * _COPIES).cast("int")
    copies = blocks.withColumn("_copy", F.explode(F.array_repeat(F.lit(True), size)))
    return copies.drop("weight", "_block", "_copy")


def _folded(df: DataFrame, names: Sequence[str], label: str) -> DataFrame:
    return materialize(folded_rows(df, names), f"{label}-folded")


def _looked_up(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the other columns of ``known``, which holds all its ``keys`` once; nulls are equal to nulls."""
    known = known.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    known = F.broadcast(known) if fits_broadcast(known) else known
    return df.join(known, same).drop(*(f"_key_{k}" for k in keys))


def _with_sides(folded: DataFrame, label: str, split_seed: int) -> DataFrame:
    """Folded rows with ``_train``: whether they are in the training share, a digest that is made once per keys."""
    sides = folded.select(*ROW_KEYS).distinct().withColumn("_train", in_training(ROW_KEYS, seed=split_seed))
    return _looked_up(folded, materialize(sides, f"{label}-sides"), ROW_KEYS)


def _in_parts(df: DataFrame, parts: int) -> DataFrame:
    # A fixed order within parts: forests sample by part and position.
    parts = max(parts, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(parts, *df.columns).sortWithinPartitions(*df.columns)


def _stored(folded: DataFrame, label: str) -> DataFrame:
    """Folded rows in even parts of a bounded size."""
    return materialize(_in_parts(folded, -(-measured_bytes(folded) // PART_BYTES)), label)


def bin_edges(df: DataFrame, names: Sequence[str], bins: int = BINS) -> dict[str, list[float]]:
    """Per column the least values of its bins, in order: all its values if there are few, else even quantiles."""
    few = df.agg(*(F.approx_count_distinct(n).alias(n) for n in names)).first().asDict()
    edges = {}
    for name in names:
        value = F.col(name).cast("double")
        known = df.filter(value.isNotNull() & ~F.isnan(value)).select(value.alias("v")).distinct()
        values = [row.v for row in known.limit(bins + 1).collect()] if few[name] <= 2 * bins else []
        edges[name] = sorted(values) if 0 < len(values) <= bins else None
    many = [name for name in names if edges[name] is None]
    # A sketch reads all rows in order of size: only for columns that need one.
    quantiles = df.approxQuantile(many, [i / bins for i in range(bins)], 1e-4) if many else []
    return edges | {name: sorted(set(found)) for name, found in zip(many, quantiles)}


def with_bins(df: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """Each column replaced by the number of its bin; a column of one bin stays, nulls stay, NaN is above all."""
    cut = {n: [float("-inf"), *e[1:], float("inf")] for n, e in edges.items() if len(e) > 1}
    if not cut:
        return df
    buckets = Bucketizer(
        splitsArray=list(cut.values()), inputCols=list(cut), outputCols=[f"_bin_{n}" for n in cut], handleInvalid="keep"
    )
    kept = (F.col(f"_bin_{n}").alias(n) if n in cut else F.col(n) for n in df.columns)
    return buckets.transform(df).select(*kept)


class _Sides(NamedTuple):
    """Scaled training rows, test rows, and by what both are scaled; whether features are numbers of bins."""

    train: DataFrame
    test: DataFrame
    deviations: Mapping[str, float | None]
    binned: bool


def _binned_sides(folded: DataFrame, names: Sequence[str], label: str) -> _Sides:
    """Rows with bins for features; training rows fold by them, whatever their keys."""
    # Read once per column and more, so the sides are looked up once; keys are not read again.
    train = materialize(folded.filter("_train").select(*dict.fromkeys(names), "weight"), f"{label}-training")
    edges = bin_edges(train, names[:-1])
    binned = with_bins(train, edges).groupBy(*dict.fromkeys(names)).agg(F.sum("weight").alias("weight"))
    binned = materialize(binned, f"{label}-binned")
    deviations = weighted_deviations(binned, names[:-1])
    test = with_bins(folded.filter("NOT _train"), edges)
    parts = -(-binned.count() // BINNED_ROWS)
    return _Sides(with_scaled(_in_parts(binned, parts), deviations), test, deviations, True)


def _scored(model, sides: _Sides, label: str, outputs: Mapping[str, Column]) -> DataFrame:
    """Test rows with ``outputs`` of the model; rows of the same bins are scored once."""
    names = list(sides.deviations)
    if not sides.binned:
        return model.transform(with_scaled(sides.test, sides.deviations)).withColumns(outputs)
    kinds = with_scaled(sides.test.select(*names).distinct(), sides.deviations)
    kinds = model.transform(kinds).select(*names, *(value.alias(n) for n, value in outputs.items()))
    return _looked_up(sides.test, materialize(kinds, f"{label}-kinds"), names)


def weighted_deviations(df: DataFrame, names: Sequence[str], weight: str = "weight") -> dict[str, float | None]:
    """Sample deviation of each column over the rows that ``df`` stands for; null below two rows.

    Deviations are summed around the means, so large values do not cancel.
    """
    w = F.col(weight)
    known = {n: F.when(F.col(n).isNotNull(), w) for n in names}
    means = df.agg(*(F.try_divide(F.sum(F.col(n) * w), F.sum(known[n])).alias(n) for n in names)).first()
    squares = {n: F.pow(F.col(n) - F.lit(means[n]).cast("double"), F.lit(2.0)) * w for n in names}
    spread = {n: F.try_divide(F.sum(squares[n]), F.when(F.sum(known[n]) > 1, F.sum(known[n]) - 1)) for n in names}
    return df.agg(*(F.sqrt(spread[n]).alias(n) for n in names)).first().asDict()


def with_scaled(df: DataFrame, deviations: Mapping[str, float | None]) -> DataFrame:
    """Add the vector ``scaled_features``: each feature divided by its deviation, or 0 if that is 0 or unknown."""
    parts = {f"_scaled_{n}": F.col(n) * (1 / d if d else 0.0) for n, d in deviations.items()}
    assembler = VectorAssembler(inputCols=list(parts), outputCol="scaled_features")
    return assembler.transform(df.withColumns(parts)).drop(*parts)


def _pipeline(features: Sequence[str], estimator) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    scaler = StandardScaler(inputCol="features", outputCol="scaled_features")
    return Pipeline(stages=[assembler, scaler, estimator])


def scale_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add ``scaled_features``: each feature divided by its sample deviation, as the models do."""
    stages = _pipeline(features, None).getStages()[:2]
    scaled = Pipeline(stages=stages).fit(df).transform(df).drop("features")
    return scaled.withColumn("scaled_features", vector_to_array("scaled_features"))


def _without_summary(model, df: DataFrame) -> PipelineModel:
    # A forest classifier's training summary holds the session, which cannot be
    # sent to tasks once the session has observed a write. A loaded model has none.
    path = scratch_path(df.sparkSession, "classifier")
    PipelineModel([model]).save(path)
    return PipelineModel.load(path)


def _sides(df: DataFrame, names: Sequence[str], label: str, split_seed: int) -> _Sides:
    """Training and test rows, folded; deviations are those of the training rows.

    ``names`` are the features and, as the last name, the label.
    """
    folded = _folded(df, [*names, *ROW_KEYS], label)
    dealt = _with_sides(folded, label, split_seed)
    if folded.count() > BINNED_ABOVE:
        return _binned_sides(dealt, names, label)
    stored = _stored(dealt, label)
    train = stored.filter("_train")
    deviations = weighted_deviations(train, names[:-1])
    return _Sides(with_scaled(train, deviations), stored.filter("NOT _train"), deviations, False)


def temperature_model(
    df: DataFrame,
    seed: int,
    split_seed: int = C.SPLIT_SEED,
    features: Sequence[str] = C.TEMPERATURE_FEATURES,
    trees: int = C.FOREST_TREES,
    depth: int = C.FOREST_DEPTH,
) -> ModelResult:
    """Forest regression of ``temp_max``; scored test rows with their absolute ``error``.

    Features that ``df`` lacks are left out; missing altitude and population
    count as zero. Equal rows are fitted and scored once, by weight.
    """
    names = fn.available(df, features)
    rows = fn.fill_zero(df.filter(F.col("temp_max").isNotNull()), ("altitude", "population"))
    sides = _sides(rows, [*names, "temp_max"], "temperature-rows", split_seed)
    forest = RandomForestRegressor(
        featuresCol="scaled_features", labelCol="temp_max", weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed
    )
    scored = _scored(forest.fit(sides.train), sides, "temperatures", {"prediction": F.col("prediction")})
    scored = materialize(scored.select("temp_max", "prediction", *ROW_KEYS, "weight"), "temperatures")
    scored = fn.with_error(unfolded(scored), "temp_max")
    return ModelResult(scored, regression_metrics(scored))


def precipitation_model(
    df: DataFrame,
    seed: int,
    split_seed: int = C.SPLIT_SEED,
    features: Sequence[str] = C.PRECIPITATION_FEATURES,
    trees: int = C.FOREST_TREES,
    depth: int = C.FOREST_DEPTH,
) -> ModelResult:
    """Forest classification of rainy days; scored test rows with class probabilities.

    Equal rows are fitted and scored once, by weight.
    """
    names = fn.available(df, features)
    rows = fn.with_precip_class(df).filter(F.col("precip_class").isNotNull())
    sides = _sides(rows, [*names, "precip_class"], "precipitation-rows", split_seed)
    forest = RandomForestClassifier(
        featuresCol="scaled_features",
        labelCol="precip_class",
        weightCol="weight",
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
    )
    outputs = {"prediction": F.col("prediction"), "probability": vector_to_array("probability")}
    scored = _scored(_without_summary(forest.fit(sides.train), sides.train), sides, "classes", outputs)
    scored = scored.select("precip_class", "prediction", "probability", "weight")
    scored = unfolded(materialize(scored, "classes"))
    return ModelResult(scored, classification_metrics(scored))


def weather_clusters(
    df: DataFrame,
    seed: int,
    k: int = C.CLUSTERS,
    features: Sequence[str] = C.CLUSTER_FEATURES,
) -> ModelResult:
    """k-means of the days' temperature and rain; every row with its ``cluster``.

    Equal rows take part once, by weight, in the scaling and in every step of
    the search.
    """
    known = df.filter(F.col("temp_avg").isNotNull() & F.col("precipitation").isNotNull())
    rows = _stored(_folded(known, [*features, *ROW_KEYS], "cluster-rows"), "cluster-rows")
    scaled = with_scaled(rows, weighted_deviations(rows, features))
    kmeans = KMeans(
        k=k, featuresCol="scaled_features", predictionCol="cluster", weightCol="weight", seed=seed
    )
    scored = kmeans.fit(scaled).transform(scaled).withColumns({
        "features": F.array(*(F.col(n).cast("double") for n in features)),
        "scaled_features": vector_to_array("scaled_features"),
    })
    scored = materialize(scored, "clusters")
    total = F.coalesce(F.sum("weight"), F.lit(0).cast("long"))
    metrics = scored.agg(F.lit(k).cast("long").alias("clusters_count"), total.alias("total_records"))
    return ModelResult(unfolded(scored), metrics)
