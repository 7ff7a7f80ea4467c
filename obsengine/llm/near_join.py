"""Exact n-gram Jaccard self-join by grouped prefixes.

Two documents link when their sets of shingles have a Jaccard similarity of at
least ``percent``. The join goes through four narrowing levels:

1. documents with the same set form a class;
2. classes with the same size and the same prefix form a group. A prefix holds
   the rarest shingles, enough that two linked documents share one. Rarity
   comes from a counting table of fixed size over all documents, so any size
   of corpus has one global order;
3. groups meet on prefix shingles, filtered by size and by the overlap that
   their positions still allow;
4. group pairs are expanded to members and verified on the whole sets.

Only connected classes are asked for, so pairs inside what is known to be one
component need no check. First each group meets at most two pivots, those that
share most of its prefix, which is linear however many documents are alike.
Then groups of different components that share a shingle meet in blocks of
bounded size, never two of the component that holds most of them: where many
share it, once to link each to the one that seems most alike, and then for all
pairs that are still apart. A block hands on only pairs whose sizes, prefix positions and
bitmaps allow the similarity, not the pairs it compares.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from obsengine.llm.common import (
    arrow_rows,
    bitmap,
    components,
    discard,
    free_shuffles,
    possibly,
    slices,
    whole_row,
)
from obsengine.llm.shingles import shingle_set
from obsengine.session import materialize, scratch_path

#: Cells of the counting table and slices in which partial tables are added up.
TABLE_BITS = 22
SLICES = 128

#: Bits of a set's bitmap, and groups per side of a block.
SET_BITS = 512
BLOCK = 1024
#: Shares of the postings that are shuffled one after the other, so that disk holds one of them at a time.
PASSES = 4
#: Groups sharing a token from which the first meeting is for the most alike only.
OFTEN = 64


def _rarity(docs: DataFrame, size: int) -> np.ndarray:
    """One byte per cell: the logarithm of how many documents have a shingle hashed there.

    Tasks count into tables of ``2**TABLE_BITS`` cells, slices of which are
    added up by other tasks; the driver gets 4 MB whatever the input.
    """
    width = (1 << TABLE_BITS) // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << TABLE_BITS, np.uint32)
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                np.add.at(table, shingle_set(text, size) >> np.uint64(64 - TABLE_BITS), 1)
        for k in range(SLICES):
            part = np.minimum(table[k * width : (k + 1) * width], 65_535).astype("<u2")
            if part.any():
                yield pa.RecordBatch.from_pydict({"slice": [k], "counts": [part.tobytes()]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                sums.setdefault(k, np.zeros(width, np.int64))
                sums[k] += np.frombuffer(part, "<u2")
        for k, total in sums.items():
            level = (4 * np.log2(1 + total)).astype(np.uint8)
            yield pa.RecordBatch.from_pydict({"slice": [k], "levels": [level.tobytes()]})

    counted = docs.select("_bytes").mapInArrow(count, "slice bigint, counts binary")
    summed = counted.repartition(32, "slice").mapInArrow(add, "slice bigint, levels binary")
    with arrow_rows(docs.sparkSession):
        rows = summed.collect()
    table = np.zeros((SLICES, width), np.uint8)
    for row in rows:
        table[row["slice"]] = np.frombuffer(row["levels"], np.uint8)
    return table.reshape(-1)


def _key(values: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(values.tobytes())


def _prefixes(docs: DataFrame, rarity, common: int, size: int, percent: int) -> DataFrame:
    """Per row: id, n, the 128-bit key of its set, the 64-bit name of its group, its prefix
    and how many of that are not very common, that is of a level up to ``common``."""

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = rarity.value
        for batch in slices(batches):
            sizes, keys, groups, parts, cold, bits = [], [], [], [], [], []
            for text in batch.column(1).to_pylist():
                found = shingle_set(text, size)
                n = len(found)
                sizes.append(n)
                if not n:
                    keys.append(None)
                    groups.append(None)
                    parts.append(found.view(np.int64))
                    cold.append(0)
                    bits.append(None)
                    continue
                order = np.lexsort((found, level[found >> np.uint64(64 - TABLE_BITS)]))
                head = found[order[: n - (percent * n + 99) // 100 + 1]]
                keys.append(_key(found))
                name = xxhash.xxh3_64_intdigest(head.tobytes() + n.to_bytes(8, "little"))
                groups.append(name - (1 << 63))
                parts.append(head.view(np.int64))
                cold.append(int((level[head >> np.uint64(64 - TABLE_BITS)] <= common).sum()))
                marks = np.zeros(SET_BITS, bool)
                marks[found & np.uint64(SET_BITS - 1)] = True
                bits.append(np.packbits(marks).tobytes())
            offsets = np.cumsum([0, *map(len, parts)])
            values = np.concatenate(parts) if parts else np.empty(0, np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column(0),
                    "n": pa.array(sizes, pa.int64()),
                    "key": pa.array(keys, pa.binary()),
                    "gid": pa.array(groups, pa.int64()),
                    "cold": pa.array(cold, pa.int32()),
                    "bits": pa.array(bits, pa.binary()),
                    "prefix": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values)),
                }
            )

    kind = dict(docs.dtypes)["id"]
    return docs.select("id", "_bytes").mapInArrow(
        prefix, f"id {kind}, n bigint, key binary, gid bigint, cold int, bits binary, prefix array<bigint>"
    )


def _common_level(rarity: np.ndarray) -> int:
    """Levels above this are cells counted far above the mean."""
    return int(4 * np.log2(32 * np.exp2(rarity / 4).mean() + 64))


def _shared(postings: DataFrame) -> DataFrame:
    """The postings (token, gid, n, at) without tokens that only one group has.

    One shuffle by token and a pass over sorted rows that keeps a row if a
    neighbour has its token. Very common tokens are let through as they are
    (the prefix has them last, from ``cold`` on), so no task is given all rows
    of one.
    """

    def drop_single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far, and whether it is known to be kept
        for batch in batches:
            if not batch.num_rows:
                continue
            token = batch.column(0).to_numpy()
            same = token[1:] == token[:-1]
            keep = np.zeros(len(token), bool)
            keep[1:] |= same
            keep[:-1] |= same
            if held is not None and held[0].column(0)[0].as_py() == token[0]:
                keep[0] = True
                if not held[1]:
                    yield held[0]
            held = batch.slice(batch.num_rows - 1), bool(keep[-1])
            yield batch.filter(pa.array(keep))

    names = "token bigint, gid bigint, n bigint, at int"
    columns = ("token", "gid", "n", "at")
    parts = int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cold = postings.filter("at < cold").select(*columns).repartition(parts, "token")
    cold = cold.sortWithinPartitions("token").mapInArrow(drop_single, names)
    return cold.union(postings.filter("at >= cold").select(*columns))


def _shared_by_passes(groups: DataFrame, percent: int) -> DataFrame:
    """The stored postings that several groups share, with the band of their sizes.

    A token is a hash, and its remainder tells the pass in which its postings are shuffled.
    """
    spark = groups.sparkSession
    postings = groups.select("gid", "n", "cold", F.posexplode("prefix").alias("at", "token"))
    # Two sizes of one band differ by less than a factor of 100 / percent.
    band = F.floor(F.log("n") / F.log(F.lit(100 / percent)) + 1e-9)
    path = scratch_path(spark, "shared")
    for turn in range(PASSES):
        part = _shared(postings.filter(F.pmod("token", F.lit(PASSES)) == turn)).withColumn("band", band)
        schema = part.schema
        part.write.mode("append").parquet(path)
        del part
        free_shuffles(spark)
    return spark.read.schema(schema).parquet(path)


def _verified(
    docs: DataFrame, classes: DataFrame, pairs: DataFrame, size: int, percent: int, unique: bool
) -> DataFrame:
    """The pairs (a, b) of class keys whose whole sets are similar enough.

    Sets are rebuilt from one document per class. The side ``b`` (pivots) is
    joined first, on rows that carry no set yet. ``unique``: no id repeats, so
    each class is rebuilt once anyway.
    """
    pairs = materialize(pairs.distinct(), "pairs")
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b"))).distinct()
    wanted = materialize(classes.join(wanted, "key", "left_semi").select("key", "doc"), "wanted")
    near = possibly(docs.select("id", "_bytes"), F.col("id"), bitmap(wanted, "doc"))
    texts = near.filter("_possible").join(
        wanted.select("key", "doc"), F.col("id").eqNullSafe(F.col("doc"))
    )

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys, sets = [], []
            for key, text in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                found = shingle_set(text, size)
                if _key(found) == key:
                    keys.append(key)
                    sets.append(found.tobytes())
            yield pa.RecordBatch.from_pydict(
                {"key": pa.array(keys, pa.binary()), "set": pa.array(sets, pa.binary())}
            )

    sets = texts.select("key", "_bytes").mapInArrow(rebuild, "key binary, set binary")
    with arrow_rows(docs.sparkSession):
        sets = materialize(sets if unique else sets.dropDuplicates(["key"]), "sets")
    free_shuffles(docs.sparkSession)  # of the texts

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            a, b, left, right = (batch.column(i).to_pylist() for i in range(4))
            kept = []
            for i, (x, y) in enumerate(zip(left, right, strict=True)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    kept.append(i)
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array([a[i] for i in kept], pa.binary()), "b": pa.array([b[i] for i in kept], pa.binary())}
            )

    full = pairs.join(sets.select(F.col("key").alias("b"), F.col("set").alias("right")), "b").join(
        sets.select(F.col("key").alias("a"), F.col("set").alias("left")), "a"
    )
    compared = full.select("a", "b", "left", "right").mapInArrow(verify, "a binary, b binary")
    with arrow_rows(docs.sparkSession):
        similar = materialize(compared, "similar")
    discard(pairs, wanted, sets)
    return similar


def _known(links: DataFrame) -> DataFrame:
    """(key, root) of the classes that some link touches."""
    touched = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    return materialize(components(touched, links), "known").withColumnRenamed("node", "key")


def _torn(members_at: DataFrame) -> DataFrame:
    """Pairs of members of one group that are in different components."""
    spread = members_at.groupBy("gid").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    torn = members_at.join(spread.filter("low <> high").select("gid"), "gid", "left_semi")
    return (
        torn.select("gid", F.col("key").alias("a"), F.col("root").alias("ra"))
        .join(torn.select("gid", F.col("key").alias("b"), F.col("root").alias("rb")), "gid")
        .filter("a < b AND ra <> rb")
        .select("a", "b")
    )


def _meetings(shared: DataFrame, members_at: DataFrame, percent: int, nearest_only: bool) -> DataFrame:
    """Stored group pairs (ga, gb) of different components that share a token and may be similar.

    Per token, groups outside its main component meet all groups. Both sides
    are cut into blocks of about :data:`BLOCK` groups by hash, and a task sees
    one pair of blocks at a time. ``nearest_only``: each group outside gives
    only the partner that its bitmap shows as most alike.
    """
    root = F.xxhash64("root")
    spread = members_at.groupBy("gid").agg(
        F.min(root).alias("low"), F.max(root).alias("high"), F.min("bits").alias("bits"), F.max("bits").alias("top")
    )
    # A bitmap stands for a group only if it is that of all its members.
    spread = spread.withColumn("bits", F.when(F.col("bits") == F.col("top"), F.col("bits"))).drop("top")
    spread = materialize(spread, "spread")
    placed = materialize(shared.join(spread.drop("bits"), "gid"), "placed")
    ends = placed.groupBy("token").agg(F.min("low").alias("x"), F.max("high").alias("y"))
    still = placed.join(ends.filter("x <> y").select("token"), "token", "left_semi")
    per_part = still.groupBy("token", "low").agg(
        F.count("*").alias("c"), F.count_if(F.col("low") == F.col("high")).alias("whole")
    )
    layout = per_part.groupBy("token").agg(
        F.max_by("low", F.struct("whole", "low")).alias("main"), F.max("whole").alias("inside"),
        F.sum("c").alias("all"),
    )
    blocks = lambda c: F.greatest(F.ceil(c / BLOCK), F.lit(1)).cast("long")
    layout = layout.select(
        "token", "main", blocks(F.col("all")).alias("many"),
        blocks(F.col("all") - F.col("inside")).alias("few"),
    )
    laid = still.join(layout, "token").join(spread.select("gid", "bits"), "gid")
    in_main = (F.col("low") == F.col("main")) & (F.col("low") == F.col("high"))
    place = lambda c: F.pmod(F.xxhash64("gid"), F.col(c))
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    columns = ("gid", "n", "at", "low", "high", "bits")
    outside = laid.filter(~in_main).select(
        "token", place("few").alias("i"), every("many").alias("j"), F.lit(0).alias("side"), *columns
    )
    anyone = laid.select(
        "token", every("few").alias("i"), place("many").alias("j"),
        F.when(in_main, 2).otherwise(1).alias("side"), *columns,
    )
    parts = int(shared.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ("token", "i", "j")
    dealt = outside.union(anyone).repartition(parts, *keys).sortWithinPartitions(*keys, "side")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            starts = _starts(held)
            if len(starts) > 1:
                yield _compared(held.slice(0, starts[-1]), starts[:-1], percent, nearest_only)
                held = held.slice(starts[-1]).combine_chunks()
        if held is not None and held.num_rows:
            yield _compared(held, _starts(held), percent, nearest_only)

    met = materialize(dealt.mapInArrow(compare, "ga bigint, gb bigint").distinct(), "met")
    discard(spread, placed)
    return met


def _starts(table: pa.Table) -> np.ndarray:
    """Rows at which another (token, i, j) begins."""
    if not table.num_rows:
        return np.empty(0, np.int64)
    change = np.zeros(table.num_rows, bool)
    change[0] = True
    for name in ("token", "i", "j"):
        values = table[name].to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(change)


def _compared(table: pa.Table, starts: np.ndarray, percent: int, nearest_only: bool) -> pa.RecordBatch:
    """The pairs of each block that size, positions and bitmaps allow."""
    gid, n, at, low, high, side = (table[c].to_numpy() for c in ("gid", "n", "at", "low", "high", "side"))
    packed = table["bits"].to_pylist()
    marked = np.array([b is not None for b in packed], bool)
    blank = bytes(SET_BITS // 8)
    bits = np.frombuffer(b"".join(b or blank for b in packed), np.uint64).reshape(len(packed), -1)
    found_a, found_b = [], []
    for begin, end in zip(starts, [*starts[1:], table.num_rows], strict=True):
        cut = begin + int(np.searchsorted(side[begin:end], 1))
        b = slice(cut, end)
        for step in range(begin, cut, 64):
            a = slice(step, min(step + 64, cut))
            na, nb = n[a][:, None], n[b][None]
            ok = (gid[a][:, None] != gid[b]) & ((side[b] == 2) | (gid[a][:, None] < gid[b]))
            ok &= (low[a][:, None] != low[b]) | (high[a][:, None] != high[b]) | (low[a] != high[a])[:, None]
            ok &= 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)
            needed = -(-percent * (na + nb) // (100 + percent))
            ok &= 1 + np.minimum(na - at[a][:, None] - 1, nb - at[b] - 1) >= needed
            rows, columns = np.nonzero(ok)
            if not len(rows):
                continue
            x, y = bits[a][rows], bits[b][columns]
            bound = np.minimum(
                n[a][rows] - np.bitwise_count(x & ~y).sum(1), n[b][columns] - np.bitwise_count(y & ~x).sum(1)
            )
            bound = np.where(marked[a][rows] & marked[b][columns], bound, np.minimum(n[a][rows], n[b][columns]))
            keep = bound >= needed[rows, columns]
            rows, columns, bound = rows[keep], columns[keep], bound[keep]
            if nearest_only and len(rows):
                order = np.lexsort((columns, -bound / (n[a][rows] + n[b][columns] - bound), rows))
                order = order[np.flatnonzero(np.diff(rows[order], prepend=-1))]
                rows, columns = rows[order], columns[order]
            found_a.append(gid[a][rows])
            found_b.append(gid[b][columns])
    none = [np.empty(0, np.int64)]
    return pa.RecordBatch.from_pydict(
        {"ga": np.concatenate(found_a or none), "gb": np.concatenate(found_b or none)}
    )


def near_join(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", *, size: int = 5, percent: int = 75
) -> DataFrame:
    """(id, n_shingles, component_id) of every row; the component is its smallest id.

    A null or blank text has no shingles and links with nothing: its component
    is its own id. Rows with equal sets are always one component, so repeated
    rows are; ids may repeat, each row then counts with its own text. A null id
    is passed through and is never the smallest. Other columns are not read.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text).cast("binary").alias("_bytes"))
    spark = docs.sparkSession
    levels = _rarity(base, size)
    free_shuffles(spark)  # of the counting tables
    rarity = spark.sparkContext.broadcast(levels)
    with arrow_rows(spark):
        rows = materialize(_prefixes(base, rarity, _common_level(levels), size, percent), "prefixes")
    rarity.unpersist()
    full = rows.filter("n > 0")
    classes = full.groupBy("key", "gid", "n", "bits").agg(F.min("id").alias("doc"))
    classes = materialize(classes, "classes")

    unique = rows.groupBy("id").count().filter("count > 1").isEmpty()
    free_shuffles(spark)  # of the classes

    # Only groups of several rows are brought together to be made one.
    several = full.groupBy("gid").count().filter("count > 1").select("gid")
    marked = possibly(full.select("gid", "n", "cold", "prefix"), F.col("gid"), bitmap(several, "gid"))
    columns = ("gid", "n", "cold", "prefix")
    groups = marked.filter(~F.col("_possible")).select(*columns).union(
        marked.filter("_possible").select(*columns).distinct()
    )
    members = materialize(classes.select("gid", "key", "bits"), "members")
    groups = materialize(groups, "groups")
    prefixes, rows = rows, materialize(rows.select("id", "n", "key"), "rows")
    discard(prefixes)  # only the groups are read from now on
    shared = _shared_by_passes(groups, percent)
    discard(groups)
    # The star only finds links early, so a pair may be left to the second pass.
    pivots = shared.groupBy("token", "band").agg(F.min("gid").alias("pivot"))
    star = (
        shared.join(pivots, ["token", "band"])
        .filter("gid <> pivot")
        .groupBy("gid", "n", "pivot")
        .agg(F.count("*").alias("c"))
        .filter(F.col("c") * 400 >= (100 - percent) * F.col("n"))
    )
    best = Window.partitionBy("gid").orderBy(F.desc("c"), "pivot")
    star = star.withColumn("nth", F.row_number().over(best)).filter("nth <= 2")
    star = star.select(F.col("gid").alias("ga"), F.col("pivot").alias("gb"))
    heads = members.groupBy("gid").agg(F.min("key").alias("b"), F.max("key").alias("top"))
    inside = members.join(heads.filter("b <> top"), "gid").filter("key <> b")
    pairs = _members(star, members).union(inside.select(F.col("key").alias("a"), "b"))
    links = _verified(base, classes, pairs, size, percent, unique)
    known = _known(links)
    # Only tokens of many groups gain from being joined to the most alike first.
    often = shared.groupBy("token").count().filter(F.col("count") >= OFTEN).select("token")
    crowded = materialize(shared.join(often, "token", "left_semi"), "crowded")
    for nearest_only in (True, False):
        members_at = members.join(known, "key", "left").select(
            "gid", "key", "bits", F.coalesce("root", "key").alias("root")
        )
        pairs = _members(_meetings(crowded if nearest_only else shared, members_at, percent, nearest_only), members)
        if not nearest_only:
            pairs = pairs.union(_torn(members_at))
        links = links.union(_verified(base, classes, pairs, size, percent, unique))
        if nearest_only:
            discard(crowded)
        known = _known(links)
    linked = classes.join(known, "key")
    smallest = linked.groupBy("root").agg(F.min("doc").alias("least"))
    named = linked.join(smallest, "root").select("key", "least")
    named = classes.join(named, "key", "left").select("key", F.coalesce("least", "doc").alias("least"))
    named = materialize(named, "named")
    discard(shared, members, classes)
    return _answers(rows, named).withColumnsRenamed({"id": id_col, "n": "n_shingles"})


def _answers(rows: DataFrame, named: DataFrame) -> DataFrame:
    """(id, n, component_id) of every row, the rows of no set and of large classes apart.

    A class is large if it holds more than a thousandth of the rows, so large
    ones are fewer than a thousand and their names are broadcast.
    """
    counts = rows.filter("n > 0").groupBy("key").count()
    total = rows.count()
    large = counts.filter(F.col("count") * 1000 > total).select("key")
    names = materialize(named.join(large, "key", "left_semi"), "large")
    least = F.col("least").alias("component_id")
    full = rows.filter("n > 0")
    alone = rows.filter("n = 0").select("id", "n", F.col("id").alias("component_id"))
    copies = full.join(F.broadcast(names), "key").select("id", "n", least)
    rest = full.join(F.broadcast(names.select("key")), "key", "left_anti").join(named, "key", "left")
    return alone.union(copies).union(rest.select("id", "n", least))


def _members(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Group pairs (ga, gb) as pairs (a, b) of their members' keys."""
    left = members.select(F.col("gid").alias("ga"), F.col("key").alias("a"))
    right = members.select(F.col("gid").alias("gb"), F.col("key").alias("b"))
    return pairs.join(left, "ga").join(right, "gb").select("a", "b")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id.

    Where ids repeat or are null, rows are numbered and stored first, and the
    row with the smallest number stays. Rows without words all stay.
    """
    ids = docs.groupBy(F.col(id_col).alias("id")).count()
    clear = ids.filter("count > 1 OR id IS NULL").isEmpty()
    number = F.col(id_col) if clear else F.monotonically_increasing_id()
    base = docs.select(number.alias("id"), F.col(text).alias("text"), whole_row(docs))
    if not clear:
        base = materialize(base, "numbered")
    found = near_join(base, "id", "text", **options)
    gone = materialize(found.filter("component_id <> id").select("id"), "gone")
    marked = possibly(base.select("id", "row"), F.col("id"), bitmap(gone, "id"))
    kept = marked.filter(~F.col("_possible")).select("row").union(
        marked.filter("_possible").join(gone, "id", "left_anti").select("row")
    )
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def near_join_sql(percent: int = 75) -> str:
    """DuckDB SQL for ``op7``: all pairs that share a shingle, and labels spread along the links."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array({lower}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
reach AS (SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reach.doc_id, pairs.b FROM reach JOIN pairs ON reach.other = pairs.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM reach JOIN sets USING (doc_id) GROUP BY doc_id, s"""
