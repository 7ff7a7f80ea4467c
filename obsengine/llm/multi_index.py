"""Approximate nearest neighbours by an inverted multi-index.

Both halves of the vectors are quantised with codebooks of their own; a cell is
a pair of centroids. A query visits cells by growing sum of its two centroid
distances, in which order a heap yields them, until enough rows are visited,
and the rows are then ranked by their exact distance.

How many rows are enough is read off the sample that the codebooks are fitted
on: the share of rows after which the wanted share of true neighbours has been
met there. The index holds every row.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from obsengine.session import materialize

#: Rows that codebooks are fitted on: those with the smallest hash of id and vector.
SAMPLE = 8_000
#: Rows of the index, and queries, that one task ranks together.
CHUNK, BLOCK = 40_000, 4_000


def _centroids(x: np.ndarray, k: int, turns: int = 12) -> np.ndarray:
    """Lloyd's method from rows picked by a fixed seed; an empty cell takes a row from afar."""
    rng = np.random.default_rng(3)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(turns):
        d = _distances(x, centres)
        nearest = d.argmin(1)
        far = np.argsort(-d[np.arange(len(x)), nearest])
        for j in range(len(centres)):
            mine = nearest == j
            centres[j] = x[mine].mean(0) if mine.any() else x[far[j % len(far)]]
    return centres


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres."""
    return np.maximum((x**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * x @ centres.T, 0)


@dataclass
class Codebooks:
    """Centroids of the two halves and the share of rows to visit."""

    cut: int
    first: np.ndarray
    second: np.ndarray
    share: float = 1.0

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _distances(x[:, : self.cut], self.first), _distances(x[:, self.cut :], self.second)

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.halves(x)
        return a.argmin(1) * len(self.second) + b.argmin(1)


def visit(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, wanted: int) -> list[int]:
    """Cells in the order of a[i] + b[j] until they hold ``wanted`` rows (or all cells).

    The heap holds the front of pairs: (i, j) enters when its neighbours (i - 1, j)
    and (i, j - 1) in sorted order have left.
    """
    oa, ob = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    sa, sb = a[oa].tolist(), b[ob].tolist()
    width = len(sb)
    done = [0] * len(sa)  # per sorted i, how many j have left
    heap = [(sa[0] + sb[0], 0, 0)]
    out, seen = [], 0
    while heap and seen < wanted:
        _, i, j = heapq.heappop(heap)
        done[i] = j + 1
        cell = int(oa[i]) * width + int(ob[j])
        if sizes[cell]:
            out.append(cell)
            seen += int(sizes[cell])
        if j + 1 < width and (i == 0 or done[i - 1] > j + 1):
            heapq.heappush(heap, (sa[i] + sb[j + 1], i, j + 1))
        if i + 1 < len(sa) and done[i + 1] == j:
            heapq.heappush(heap, (sa[i + 1] + sb[j], i + 1, j))
    return out


def fit(sample: np.ndarray, k: int, neighbours: int, recall: float) -> Codebooks:
    """Codebooks of at most ``k`` centroids per half, and the share of rows to visit.

    Sample rows stand for queries: for each of their true neighbours in the
    sample it is known after which share of rows its cell is reached.
    """
    cut = max(1, sample.shape[1] // 2)
    books = Codebooks(cut, _centroids(sample[:, :cut], k), _centroids(sample[:, cut:], k) if sample.shape[1] > 1 else np.zeros((1, 0)))
    cells = books.cells(sample)
    sizes = np.bincount(cells, minlength=len(books.first) * len(books.second))
    queries = np.arange(0, len(sample), max(1, len(sample) // 200))
    a, b = books.halves(sample[queries])
    reached = []
    for row, q in enumerate(queries):
        d = ((sample - sample[q]) ** 2).sum(1)
        d[q] = np.inf
        near = np.argsort(d, kind="stable")[: min(neighbours, len(sample) - 1)]
        order = visit(a[row], b[row], sizes, len(sample))
        after = np.zeros(len(sizes))
        after[order] = np.cumsum(sizes[order]) / len(sample)
        reached += after[cells[near]].tolist()
    books.share = float(np.quantile(reached, recall)) if reached else 1.0
    return books


def usable(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, v) of the rows that take part, v as doubles.

    Vectors that are null, empty or all zero, or hold null or non-finite
    components, and rows with a null id take no part.
    """
    v = F.col(vector).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & F.coalesce(good, F.lit(False)) & F.exists("v", lambda x: x != 0)
    )


def nearest(
    vectors: DataFrame, queries, *, id_col: str = "vec_id", vector: str = "embedding",
    k: int = 10, centroids: int = 64, recall: float = 0.96,
) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` nearest rows found for each query row.

    ``queries`` is a condition on the column ``id``. The score is the Euclidean
    distance in double precision, ties go to the smaller id, and rows with the
    query's own id are no candidates. Repeated rows are candidates each;
    repeated query ids are asked once. Fewer candidates than ``k`` give all of
    them. Vectors of different lengths have no distance: each length that a
    query has is an index of its own, and the candidates of a query are the
    rows of its length. A query id repeated with several lengths is asked with
    each, and its nearest of all are ranked together.
    """
    rows = materialize(usable(vectors, id_col, vector), "vectors")
    per_length = rows.groupBy(F.size("v").alias("d")).agg(F.count_if(queries(F.col("id"))).alias("asked"))
    lengths = sorted(r["d"] for r in per_length.filter("asked > 0").collect())  # a few
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not lengths:
        return vectors.sparkSession.createDataFrame([], schema)
    ranked = [_ranked(rows.filter(F.size("v") == d), d, queries, k, centroids, recall) for d in lengths]
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = reduce(DataFrame.union, ranked).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _ranked(rows: DataFrame, length: int, queries, k: int, centroids: int, recall: float) -> DataFrame:
    """(query_id, vec_id, score) of the nearest found in every chunk, among rows of one length."""
    spark = rows.sparkSession
    picked = rows.orderBy(F.xxhash64("id", "v"), "id").limit(SAMPLE).select("v").toPandas()
    books = spark.sparkContext.broadcast(fit(np.stack(picked["v"]), centroids, k, recall))

    def locate(batches):
        for frame in batches:
            x = np.stack(frame["v"]) if len(frame) else np.zeros((0, length))
            yield frame.assign(cell=books.value.cells(x)) if len(frame) else frame.assign(cell=pd.Series(dtype="int64"))

    index = materialize(rows.mapInPandas(locate, "id bigint, v array<double>, cell bigint"), "index")
    counts = np.zeros(len(books.value.first) * len(books.value.second), np.int64)
    for row in index.groupBy("cell").count().collect():  # at most centroids ** 2 rows
        counts[row["cell"]] = row["count"]
    total = int(counts.sum())
    # Consecutive cells share a chunk while they fit; a cell that is larger has chunks of its own.
    chunk_of, parts_of, chunk, filled = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64), 0, 0
    for cell, n in enumerate(counts.tolist()):
        if filled and filled + n > CHUNK:
            chunk, filled = chunk + 1, 0
        chunk_of[cell], parts_of[cell] = chunk, -(-n // CHUNK) or 1
        filled += n
    layout = spark.sparkContext.broadcast((chunk_of, parts_of, counts))
    asked = rows.filter(queries(F.col("id"))).dropDuplicates(["id"])
    blocks = max(1, -(-asked.count() // BLOCK))
    wanted = max(int(np.ceil(books.value.share * total)), min(total, k + 1))

    def probe(batches):
        chunks, parts, held = layout.value
        for frame in batches:
            out = []
            if len(frame):
                a, b = books.value.halves(np.stack(frame["v"]))
                for row, (q, v) in enumerate(zip(frame["id"], frame["v"], strict=True)):
                    cells = np.array(visit(a[row], b[row], held, wanted))
                    for c in np.unique(chunks[cells]):
                        mine = np.sort(cells[chunks[cells] == c])
                        for part in range(int(parts[mine].max())):
                            out.append((int(c), part, q, v, mine[parts[mine] > part]))
            yield pd.DataFrame(out, columns=["chunk", "part", "query_id", "v", "cells"])

    probes = asked.mapInPandas(probe, "chunk bigint, part bigint, query_id bigint, v array<double>, cells array<bigint>")
    probes = probes.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))

    def place(batches):
        chunks, parts, _ = layout.value
        for frame in batches:
            cells = frame["cell"].to_numpy(np.int64)
            mixed = (frame["id"].to_numpy(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
            yield frame.assign(chunk=chunks[cells], part=(mixed % parts[cells].astype(np.uint64)).astype(np.int64))

    placed = index.mapInPandas(place, "id bigint, v array<double>, cell bigint, chunk bigint, part bigint")
    placed = placed.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def rank(near: pd.DataFrame, queried: pd.DataFrame) -> pd.DataFrame:
        """Exact distances of a chunk's visited rows to a block of queries; both sides have a bounded size."""
        if not len(near) or not len(queried):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        near = near.sort_values(["cell", "id"], kind="stable")
        cells, ids, x = near["cell"].to_numpy(), near["id"].to_numpy(), np.stack(near["v"])
        found = []
        for q, v, visited in zip(queried["query_id"], queried["v"], queried["cells"], strict=True):
            begin, end = np.searchsorted(cells, visited, "left"), np.searchsorted(cells, visited, "right")
            at = np.concatenate([np.arange(s, e) for s, e in zip(begin, end, strict=True)])
            at = at[ids[at] != q]
            d = np.sqrt(((x[at] - v) ** 2).sum(1))
            best = np.lexsort((ids[at], d))[:k]
            found.append(pd.DataFrame({"query_id": q, "vec_id": ids[at[best]], "score": d[best]}))
        return pd.concat(found)

    keys = ("chunk", "part", "block")
    return placed.groupBy(*keys).cogroup(probes.groupBy(*keys)).applyInPandas(
        lambda near, queried: rank(near, queried), "query_id bigint, vec_id bigint, score double"
    )
