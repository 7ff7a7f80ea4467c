"""Quality classifier: a sparse ensemble of rules taken from trees.

Shallow boosted trees are grown on a bounded sample of labelled rows. Every
path from a root is a rule, a conjunction of threshold tests on statistics;
logistic regression under an L1 penalty keeps few of them. The kept rules
become one Spark expression, so scoring a corpus runs no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsengine.llm.quality_rules import STATISTICS, statistics
from obsengine.session import materialize

FEATURES = (*STATISTICS, "n_words")

#: Labelled rows that training may use: those with the smallest hash of their id.
SAMPLE = 20_000

Path = tuple[tuple[int, bool, float], ...]  # (feature, above, threshold)


def _candidates(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Thresholds per feature: midpoints between neighbouring quantiles that differ."""
    cuts = []
    for column in x.T:
        steps = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)))
        cuts.append((steps[1:] + steps[:-1]) / 2)
    return cuts


def _grow(x, g, h, rows, cuts, depth: int, least: int, path: Path, found: list[Path], leaf: np.ndarray) -> None:
    """Split where the second-order gain is largest; fill ``leaf`` with the steps and ``found`` with the paths."""
    best = (1e-6, -1, 0.0)
    total = g[rows].sum(), h[rows].sum()
    if depth:
        for j, thresholds in enumerate(cuts):
            place = np.searchsorted(thresholds, x[rows, j], side="left")
            n = len(thresholds) + 1
            gs = np.bincount(place, g[rows], n).cumsum()[:-1]
            hs = np.bincount(place, h[rows], n).cumsum()[:-1]
            ns = np.bincount(place, minlength=n).cumsum()[:-1]
            gain = gs**2 / (hs + 1) + (total[0] - gs) ** 2 / (total[1] - hs + 1) - total[0] ** 2 / (total[1] + 1)
            gain[(ns < least) | (len(rows) - ns < least)] = -1
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), j, thresholds[int(gain.argmax())])
    if best[1] < 0:
        leaf[rows] = total[0] / (total[1] + 1)
        return
    _, j, threshold = best
    above = x[rows, j] > threshold
    for side in (False, True):
        longer = (*path, (j, side, float(threshold)))
        found.append(longer)
        _grow(x, g, h, rows[above == side], cuts, depth - 1, least, longer, found, leaf)


def tree_rules(x: np.ndarray, y: np.ndarray, *, trees: int, depth: int, rate: float, bins: int, least: int) -> list[Path]:
    """Distinct paths of boosted trees, each seeing the half of the rows that its seed picks."""
    cuts = _candidates(x, bins)
    found: list[Path] = []
    f = np.zeros(len(y))
    for seed in range(trees):
        p = 1 / (1 + np.exp(-f))
        rows = np.flatnonzero(np.random.default_rng(seed).random(len(y)) < 0.5)
        leaf = np.zeros(len(y))
        paths: list[Path] = []
        _grow(x, y - p, p * (1 - p), rows, cuts, depth, least, (), paths, leaf)
        found += paths
        f[rows] += rate * leaf[rows]
    return list(dict.fromkeys(found))


def covers(x: np.ndarray, path: Path) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, above, threshold in path:
        out &= (x[:, j] > threshold) == above
    return out


def lasso_logistic(r: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated proximal gradient steps; the intercept goes unpunished."""
    n, m = r.shape
    scale = np.maximum(r.std(0), 0.05)
    z = np.column_stack([r / scale, np.ones(n)])
    v = np.ones(m + 1) / np.sqrt(m + 1)
    for _ in range(20):
        v = z.T @ (z @ v)
        v /= np.linalg.norm(v)
    step = 4 * n / (np.linalg.norm(z @ v) ** 2 * 1.05)
    w = ahead = np.zeros(m + 1)
    t = 1.0
    for _ in range(steps):
        slope = z.T @ (1 / (1 + np.exp(-(z @ ahead))) - y) / n
        new = ahead - step * slope
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * penalty, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w[:-1] / scale, float(w[-1])


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted rules and an intercept on the log-odds scale."""

    rules: tuple[tuple[Path, float], ...]
    intercept: float

    def score(self) -> Column:
        """Probability of label 1 as one Spark expression over the statistics."""
        total = F.lit(self.intercept)
        for path, weight in self.rules:
            test = F.lit(True)
            for j, above, threshold in path:
                value = F.col(FEATURES[j])
                test = test & (value > threshold if above else value <= threshold)
            total = total + F.when(test, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def fit(labelled: DataFrame, label: str, *, sample: int = SAMPLE, penalty: float = 2e-4) -> RuleEnsemble:
    """Fit on at most ``sample`` rows of ``labelled`` (doc_id, :data:`FEATURES`, label 0 or 1).

    Without rows of both labels the ensemble is the share of label 1 alone,
    smoothed by one row of each.
    """
    rows = (
        labelled.orderBy(F.xxhash64("doc_id"), "doc_id", *FEATURES).limit(sample)
        .select(*FEATURES, label).toPandas()
    )
    y = rows[label].to_numpy(np.float64)
    share = (y.sum() + 1) / (len(y) + 2)
    if len(set(y.tolist())) < 2:
        return RuleEnsemble((), float(np.log(share / (1 - share))))
    x = rows[list(FEATURES)].to_numpy(np.float64)
    paths = tree_rules(x, y, trees=24, depth=3, rate=0.3, bins=64, least=max(2, len(y) // 500))
    r = np.column_stack([covers(x, p) for p in paths] or [np.zeros(len(y), bool)]).astype(np.float64)
    weights, intercept = lasso_logistic(r, y, penalty)
    kept = tuple((p, float(w)) for p, w in zip(paths, weights, strict=False) if abs(w) > 1e-6)
    return RuleEnsemble(kept, intercept)


def classify(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Labels are learned only from ids whose CRC-32 as text leaves a remainder
    other than 0 by 5. A null text scores as an empty one. A null id has no
    label and is not held out; an id with several labels counts as the
    smallest, and repeated rows score alike.
    """
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    stats = materialize(statistics(docs), "statistics").withColumn("held_out", held)
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("_label"))
    training = stats.filter(~F.col("held_out")).join(known, "doc_id")
    score = fit(training, "_label").score()
    scored = stats.select("doc_id", "held_out", score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
