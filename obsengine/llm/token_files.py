"""Token ids of a corpus as files of frequency-ranked, byte-aligned codes.

Format. A folder holds three Parquet tables, so that Spark's committer writes
them and any store that Spark reads can hold them:

``ranks``  token id per rank; rank 0 is the most frequent id.
``data``   one row per document in ascending id order: doc_id, part, start (ids
           before it in its part), n_tokens, control, codes.
``parts``  ids before each part.

A code is a rank in 1 to 4 little-endian bytes. Four codes share a control
byte, which holds each length less 1 in two bits, the first in the lowest; the
last control byte is filled up with zeros. Control bytes and codes stand apart,
so lengths of all codes come from one table lookup and codes are then gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from obsengine.llm.tokens import encoder, ids_crc32
from obsengine.session import scratch_path

#: Ids in one sorted part of the files.
PART_IDS = 4_000_000

_LENGTHS = ((np.arange(256)[:, None] >> np.arange(0, 8, 2)) & 3) + 1
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


#: Documents encoded or decoded by one pass over arrays, which bounds their memory.
_CHUNK = 400


def _within(sizes: np.ndarray) -> np.ndarray:
    """Position of each entry in its document, filled up to whole quads."""
    quads = -(-sizes // 4) * 4
    return np.arange(quads.sum()) - np.repeat(np.cumsum(quads) - quads, quads)


def encode_many(ranks: np.ndarray, sizes: np.ndarray) -> list[tuple[bytes, bytes]]:
    """(control bytes, codes) of each document; ``ranks`` below 2**32 hold one after the other."""
    sizes = sizes.astype(np.int64)
    quads = -(-sizes // 4) * 4
    real = _within(sizes) < np.repeat(sizes, quads)
    filled = np.zeros(len(real), "<u4")
    filled[real] = ranks
    lengths = 1 + (filled > 0xFF).astype(np.uint8) + (filled > 0xFFFF) + (filled > 0xFFFFFF)
    bits = (lengths - 1).reshape(-1, 4)
    control = (bits[:, 0] | bits[:, 1] << 2 | bits[:, 2] << 4 | bits[:, 3] << 6).astype(np.uint8).tobytes()
    lengths[~real] = 0
    codes = filled.view(np.uint8).reshape(-1, 4)[np.arange(4) < lengths[:, None]].tobytes()
    control_ends = np.cumsum(quads) // 4
    sums = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    code_ends = sums[np.cumsum(quads)] if len(quads) else quads
    out, c, d = [], 0, 0
    for ce, de in zip(control_ends.tolist(), code_ends.tolist(), strict=True):
        out.append((control[c:ce], codes[d:de]))
        c, d = ce, de
    return out


def decode_many(control: list[bytes], codes: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """The ranks of all documents, one after the other."""
    sizes = sizes.astype(np.int64)
    lengths = _LENGTHS[np.frombuffer(b"".join(control), np.uint8)].reshape(-1)
    lengths = lengths[_within(sizes) < np.repeat(sizes, -(-sizes // 4) * 4)]
    starts = np.cumsum(lengths) - lengths
    data = np.frombuffer(b"".join(codes) + b"\0\0\0", np.uint8).astype(np.uint32)
    words = data[starts] | data[starts + 1] << 8 | data[starts + 2] << 16 | data[starts + 3] << 24
    return words & _MASKS[lengths]


def _tokenised(docs: DataFrame, path: str, spaced: bool, end_id: int, width: str) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, spaced).encode
        for batch in batches:
            ids = [np.append(encode(text or ""), np.uint32(end_id)) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([x.astype(width).tobytes() for x in ids], pa.binary()),
                ],
                ["doc_id", "n_tokens", "ids"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, n_tokens bigint, ids binary")


def _ranked(stored: DataFrame, width: str) -> np.ndarray:
    """Ids from the most to the least frequent; as many as the tokenizer has, whatever the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            listed = batch.column(0).to_pylist()
            for k in range(0, len(listed), _CHUNK):
                one = np.bincount(np.frombuffer(b"".join(listed[k : k + _CHUNK]), width))
                if len(one) > len(total):
                    total = np.concatenate([total, np.zeros(len(one) - len(total), np.int64)])
                total[: len(one)] += one
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": found.astype(np.int64), "n": total[found]})

    parts = stored.select("ids").mapInArrow(count, "id bigint, n bigint")
    rows = parts.groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    return rows.sort_values(["n", "id"], ascending=[False, True])["id"].to_numpy(np.int64)


def write_ids(
    docs: DataFrame, path: str, folder: str, *, spaced: bool = False, end_id: int = 2
) -> None:
    """Tokenise whole texts and write them to ``folder`` in the format above.

    A null text counts as empty: the end id alone. Null ids come first; rows
    that repeat an id are all written, in the order of their checksums.
    """
    spark = docs.sparkSession
    width = "<u2" if _largest_id(path, end_id) < 1 << 16 else "<u4"
    raw = scratch_path(spark, "ids")
    _tokenised(docs, path, spaced, end_id, width).write.option("compression", "zstd").parquet(raw)
    stored = spark.read.parquet(raw)
    ids_of = _ranked(stored, width)
    rank_rows = [(rank, int(i)) for rank, i in enumerate(ids_of)]
    spark.createDataFrame(rank_rows, "rank bigint, id bigint").coalesce(1).write.parquet(f"{folder}/ranks")
    rank_of = np.zeros(int(ids_of.max(initial=0)) + 1, np.uint32)
    rank_of[ids_of] = np.arange(len(ids_of))
    shared = spark.sparkContext.broadcast(rank_of)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            starts = at + np.cumsum(sizes) - sizes
            at += int(sizes.sum())
            listed, pairs = batch.column(2).to_pylist(), []
            for k in range(0, len(listed), _CHUNK):
                ids = np.frombuffer(b"".join(listed[k : k + _CHUNK]), width)
                pairs += encode_many(shared.value[ids], sizes[k : k + _CHUNK])
            control, codes = [p[0] for p in pairs], [p[1] for p in pairs]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([part] * len(starts), pa.int64()), pa.array(starts, pa.int64()),
                    batch.column(1), pa.array(control, pa.binary()), pa.array(codes, pa.binary()),
                ],
                ["doc_id", "part", "start", "n_tokens", "control", "codes"],
            )

    total = stored.agg(F.sum("n_tokens")).first()[0] or 0
    kind = dict(docs.dtypes)["doc_id"]
    ordered = stored.repartitionByRange(max(1, -(-total // PART_IDS)), "doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", F.crc32("ids"))
    schema = f"doc_id {kind}, part bigint, start bigint, n_tokens bigint, control binary, codes binary"
    ordered.mapInArrow(encode, schema).write.option("compression", "zstd").parquet(f"{folder}/data")
    # One row per part, so one task can add them up.
    sizes = spark.read.parquet(f"{folder}/data").groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes.select("part", F.coalesce(before, F.lit(0)).alias("before")).write.parquet(f"{folder}/parts")


def _largest_id(path: str, end_id: int) -> int:
    return max(end_id, encoder(path, False).largest_id())


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian 32-bit) from the files."""
    data = spark.read.parquet(f"{folder}/data")
    ids_of = spark.read.parquet(f"{folder}/ranks").toPandas().sort_values("rank")["id"].to_numpy(np.uint32)
    shared = spark.sparkContext.broadcast(ids_of)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(k, _CHUNK) for k in range(0, whole.num_rows, _CHUNK)):
                sizes = batch.column(2).to_numpy()
                ranks = decode_many(batch.column(3).to_pylist(), batch.column(4).to_pylist(), sizes)
                flat = shared.value[ranks].astype("<u4")
                ids = np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else []
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), batch.column(1), batch.column(2),
                        pa.array([x.tobytes() for x in ids], pa.binary()),
                        pa.array([ids_crc32(x) for x in ids], pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids", "ids_crc32"],
                )

    # As many rows as there are parts, each of PART_IDS ids or more.
    placed = data.join(F.broadcast(spark.read.parquet(f"{folder}/parts")), "part")
    placed = placed.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "control", "codes")
    kind = dict(data.dtypes)["doc_id"]
    return placed.mapInArrow(
        decode, f"doc_id {kind}, start bigint, n_tokens bigint, ids binary, ids_crc32 bigint"
    )
