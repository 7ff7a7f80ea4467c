"""Line deduplication across documents by a deletion-neighbourhood join.

A line is its words, A-Z in lower case. A line is dropped when an earlier one,
in the order of doc_id and line number, is equal, or when both have at least
``near_words`` words and their word edit distance is at most 1. Two sequences
are within distance 1 exactly if deleting the word at the same position makes
them equal (one word replaced), or if deleting a word of one gives the other.
So every line emits all its variants with at most one word deleted, as hashed
keys; lines meet on equal keys; and real words are compared at the end.

Per key only the earliest line is needed: all lines that share a key and a
deleted position are within the bound of each other. Nothing pairs the members
of a key, so one very common line or template costs as much as its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsengine.llm.common import bitmap, discard, free_shuffles, possibly, slices, whole_row
from obsengine.llm.shingles import word_hashes
from obsengine.session import materialize

_P = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_P, -1, 1 << 64))
_LAST = (1 << 63) - 1


def _halves(hashes: np.ndarray) -> list[int]:
    """Keys of which lines within distance 1 share one: an end of the line that the edit left alone."""
    n = len(hashes)
    parts = (
        (0, n, hashes[: n // 2]), (1, n, hashes[n // 2 :]),
        (0, n - 1, hashes[: (n - 1) // 2]), (1, n - 1, hashes[(n - 1) // 2 + 1 :]),
    )
    return [xxhash.xxh3_64_intdigest(part.tobytes(), seed=2 * m + end) - (1 << 63) for end, m, part in parts]


def variants(hashes: np.ndarray) -> np.ndarray:
    """Hash of the whole sequence, then of the sequence without each of its entries."""
    n = len(hashes)
    power = np.full(n + 1, _P, np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    before = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * power[:n], out=before[1:])
    without = before[:-1] + (before[-1] - before[1:]) * _INVERSE
    out = np.concatenate([before[-1:], without])
    out[:1] += np.uint64(n) * power[-1:]
    out[1:] += np.uint64(n - 1) * power[n - 1 : n]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def within_one(a: list[bytes], b: list[bytes]) -> bool:
    """Whether at most one inserted, deleted or replaced word makes ``a`` and ``b`` equal."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def _kind(docs: DataFrame) -> str:
    """Type of the place of a document."""
    return docs.schema["doc"].dataType.simpleString()


def _line_rows(docs: DataFrame, min_words: int, near_words: int) -> DataFrame:
    """One row per line with enough words: place, 128-bit key, whether its document had it before, half keys."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: dict[str, list] = {k: [] for k in ("at", "line", "key", "again", "halves")}
            for at, text in enumerate(batch.column(1).to_pylist()):
                seen: set[bytes] = set()
                for number, line in enumerate(text.lower().split(b"\n")):
                    found = line.split()
                    if len(found) < min_words:
                        continue
                    key = xxhash.xxh3_128_digest(b" ".join(found))
                    again = key in seen
                    seen.add(key)
                    near = not again and len(found) >= near_words
                    out["at"].append(at)
                    out["line"].append(number)
                    out["key"].append(key)
                    out["again"].append(again)
                    out["halves"].append(_halves(word_hashes(found)) if near else [])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc": batch.column(0).take(pa.array(out["at"], pa.int64())), "line": pa.array(out["line"], pa.int64()),
                    "key": pa.array(out["key"], pa.binary()), "again": pa.array(out["again"], pa.bool_()),
                    **{
                        f"h{i}": pa.array([h[i] if h else None for h in out["halves"]], pa.int64())
                        for i in range(4)
                    },
                }
            )

    schema = f"doc {_kind(docs)}, line bigint, key binary, again boolean, h0 bigint, h1 bigint, h2 bigint, h3 bigint"
    return docs.mapInArrow(rows, schema)


def _near_candidates(firsts: DataFrame) -> DataFrame:
    """Distinct lines that share an end with another line, so that only these emit variants."""
    ends = firsts.filter(F.col("h0").isNotNull()).select(
        "key", "doc", "line", F.xxhash64("key").alias("k"),
        F.explode(F.array("h0", "h1", "h2", "h3")).alias("end"),
    )
    met = ends.groupBy("end").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).filter("lo <> hi")
    return ends.join(met.select("end"), "end", "left_semi").select("key", "doc", "line").distinct()


def _line_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, doc, line, body) of the wanted places, the body being words joined by spaces."""
    places = wanted.groupBy("doc").agg(F.collect_list(F.col("line")).alias("at"))
    near = possibly(docs, F.col("doc"), bitmap(wanted.select("doc"), "doc")).filter("_possible")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: dict[str, list] = {k: [] for k in ("key", "doc", "line", "body")}
            for doc, (text, at) in enumerate(zip(*(batch.column(i).to_pylist() for i in (1, 2)), strict=True)):
                lines = text.lower().split(b"\n")
                for number in at:
                    body = b" ".join(lines[number].split())
                    out["key"].append(xxhash.xxh3_128_digest(body))
                    out["doc"].append(doc)
                    out["line"].append(number)
                    out["body"].append(body)
            yield pa.RecordBatch.from_pydict(
                {
                    "key": pa.array(out["key"], pa.binary()), "doc": batch.column(0).take(pa.array(out["doc"], pa.int64())),
                    "line": pa.array(out["line"], pa.int64()), "body": pa.array(out["body"], pa.binary()),
                }
            )

    found = near.select("doc", "_bytes").join(places, "doc").select("doc", "_bytes", "at")
    return found.mapInArrow(pick, f"key binary, doc {_kind(docs)}, line bigint, body binary")


def _near_drops(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc, line) of the lines with an earlier line within distance 1, and the stored pairs it reads."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bodies = batch.column(3).to_pylist()
            hashes = [variants(word_hashes(body.split())) for body in bodies]
            sizes = np.array([len(h) for h in hashes], np.int64)
            source = np.repeat(np.arange(len(hashes)), sizes)
            flat = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
            at = np.concatenate([np.arange(-1, n - 1) for n in sizes]) if hashes else np.empty(0, np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "variant": pa.array(flat.view(np.int64)), "at": pa.array(at.astype(np.int64)),
                    "doc": batch.column(1).take(pa.array(source)), "line": batch.column(2).take(pa.array(source)),
                    "key": batch.column(0).take(pa.array(source)),
                }
            )

    emitted = lines.select("key", "doc", "line", "body").mapInArrow(
        emit, f"variant bigint, at bigint, doc {_kind(lines)}, line bigint, key binary"
    )
    place = F.struct("doc", "line", "key")
    rows = materialize(emitted.select("variant", "at", place.alias("me")), "variants")
    whole, cut = rows.filter("at = -1"), rows.filter("at >= 0")
    first = rows.groupBy("variant", "at").agg(F.min("me").alias("first"))
    first_cut = cut.groupBy("variant").agg(F.min("me").alias("first"))
    first_whole = first.filter("at = -1").select("variant", "first")
    met = (
        cut.join(first, ["variant", "at"]).select("me", "first")
        .union(cut.join(first_whole, "variant").select("me", "first"))
        .union(whole.join(first_cut, "variant").select("me", "first"))
        .filter("first < me").distinct()
    )
    pairs = materialize(met.select("me", F.col("first.key").alias("other"), F.col("me.key").alias("key")), "pairs")
    discard(rows)
    bodies = lines.select("key", "body")
    full = pairs.join(bodies.select(F.col("key").alias("other"), F.col("body").alias("before")), "other")
    full = full.join(bodies, "key").select("me.doc", "me.line", "body", "before")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            body, before = (batch.column(i).to_pylist() for i in (2, 3))
            kept = [i for i, (a, b) in enumerate(zip(body, before, strict=True)) if within_one(a.split(), b.split())]
            places = batch.select([0, 1])
            yield places.take(pa.array(kept, pa.int64()))

    return full.mapInArrow(verify, f"doc {_kind(lines)}, line bigint").distinct(), pairs


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", *, min_words: int = 3, near_words: int = 10
) -> DataFrame:
    """``row`` (all columns as a struct), ``text`` without its dropped lines, n_lines, n_exact, n_near.

    Lines with fewer than ``min_words`` words take no part and stay. n_lines
    counts those that take part; n_exact and n_near count dropped lines. Null
    texts stay null and empty ones empty; a document that loses all its lines
    keeps its row. Where ids repeat or are null, rows are numbered and stored
    first, and every row is a place of its own, in the order of id, then number;
    rows whose id is null or no whole number come last. Texts move between tasks only for documents
    that may lose a line.
    """
    number = F.col(id_col).try_cast("long")
    order = F.coalesce(number, F.lit(_LAST))
    shown = docs.select(whole_row(docs), F.col(text).alias("_text"), order.alias("doc"))
    ids = docs.groupBy(number.alias("id")).count()
    if not ids.filter("count > 1 OR id IS NULL").isEmpty():
        place = F.struct(F.col("doc").alias("id"), F.monotonically_increasing_id().alias("number"))
        shown = materialize(shown.withColumn("doc", place), "numbered")
    base = shown.select("doc", F.coalesce("_text", F.lit("")).cast("binary").alias("_bytes"))
    lines = materialize(_line_rows(base, min_words, near_words), "lines")
    firsts = lines.filter(~F.col("again")).groupBy("key").agg(
        F.min("doc").alias("doc"), F.min_by("line", "doc").alias("line"),
        *(F.max(f"h{i}").alias(f"h{i}") for i in range(4)),
    )
    firsts = materialize(firsts, "firsts")
    places = firsts.select("key", F.col("doc").alias("d0"), F.col("line").alias("l0"))
    exact = (
        lines.join(places, "key")
        .filter("again OR doc <> d0 OR line <> l0")
        .select("doc", "line", F.lit(0).alias("near"))
    )
    exact = materialize(exact, "exact")
    wanted = materialize(_near_candidates(firsts), "candidates")
    discard(lines, firsts)  # before the variants, which take most room
    texts = materialize(_line_texts(base, wanted), "bodies")
    free_shuffles(docs.sparkSession)  # of the texts
    found, spent = _near_drops(texts)
    near = found.withColumn("near", F.lit(1))
    drops = exact.union(near).groupBy("doc", "line").agg(F.min("near").alias("near"))
    drops = materialize(
        drops.groupBy("doc").agg(
            F.collect_list("line").alias("_gone"), F.count_if(F.col("near") == 0).alias("_exact"),
            F.count_if(F.col("near") == 1).alias("_near"),
        ),
        "drops",
    )

    discard(exact, wanted, texts, spent)
    marked = possibly(shown, F.col("doc"), bitmap(drops.select("doc"), "doc"))
    parts = F.split("_text", "\n")
    kept = F.filter(parts, lambda _, i: ~F.array_contains("_gone", i.cast("long")))
    n_lines = F.size(F.filter(F.split(F.coalesce("_text", F.lit("")), "\n"), lambda x: _has_words(x, min_words)))
    hit = marked.filter("_possible").join(drops, "doc", "left")
    cut = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n"))
    zero = F.lit(0).cast("long")
    return hit.select(
        "row", cut.alias("text"), n_lines.cast("long").alias("n_lines"),
        F.coalesce("_exact", zero).alias("n_exact"), F.coalesce("_near", zero).alias("n_near"),
    ).union(
        marked.filter(~F.col("_possible")).select(
            "row", F.col("_text").alias("text"), n_lines.cast("long").alias("n_lines"),
            zero.alias("n_exact"), zero.alias("n_near"),
        )
    )


def _has_words(line, least: int):
    """Whether a line has so many words; the match stops at the last of them and never goes back."""
    return F.rlike(line, F.lit("\\A(?:[\\x20\\x09-\\x0D]*+[^\\x20\\x09-\\x0D]++){%d}" % least))


def dedup_sql(min_words: int = 3, near_words: int = 10) -> str:
    """DuckDB SQL for the digest of ``op5``: every variant spelled out as a string."""
    words = (
        "list_filter(regexp_split_to_array(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
        "'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
    )
    return f"""WITH parts AS (
  SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS p FROM documents),
split AS (SELECT doc_id, i - 1 AS line, p[i] AS x
  FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM parts)),
lines AS (SELECT doc_id, line, w, array_to_string(w, ' ') AS k
  FROM (SELECT doc_id, line, {words} AS w FROM split) WHERE len(w) >= {min_words}),
numbered AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, line) AS nth FROM lines),
firsts AS (SELECT k, w, row_number() OVER (ORDER BY doc_id, line) AS o, doc_id, line
  FROM numbered WHERE nth = 1),
long AS (SELECT * FROM firsts WHERE len(w) >= {near_words}),
variants AS (
  SELECT o, -1 AS pos, k AS v FROM long
  UNION ALL
  SELECT o, pos, array_to_string(list_concat(w[1:pos], w[pos + 2:]), ' ')
  FROM (SELECT o, w, unnest(range(0, len(w))) AS pos FROM long)),
near AS (SELECT DISTINCT a.o FROM variants a JOIN variants b
  ON a.v = b.v AND b.o < a.o AND (a.pos = b.pos OR a.pos = -1 OR b.pos = -1)),
gone AS (
  SELECT doc_id, line, 0 AS near FROM numbered WHERE nth > 1
  UNION ALL SELECT doc_id, line, 1 FROM firsts WHERE o IN (SELECT o FROM near)),
by_doc AS (SELECT doc_id, list(line) AS gone, count(*) FILTER (WHERE near = 0) AS n_exact,
  count(*) FILTER (WHERE near = 1) AS n_near FROM gone GROUP BY doc_id),
counted AS (SELECT doc_id, count(*) AS n FROM lines GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_lines, coalesce(n_exact, 0) AS n_exact, coalesce(n_near, 0) AS n_near,
  sha256(array_to_string(list_transform(list_filter(range(1, len(p) + 1),
    lambda i: NOT list_contains(coalesce(gone, []), i - 1)), lambda i: p[i]), chr(10))) AS text_sha256
FROM parts LEFT JOIN by_doc USING (doc_id) LEFT JOIN counted USING (doc_id)"""
