"""Best-fit packing of tokenised documents into sequences, improved by swaps.

Tasks tokenise whole texts and cut the longer ones. Full pieces are sequences
of their own and never move. The rest is dealt by hash into shards of a known
size; each shard is packed by best fit and then improved by local search among
underfull sequences: moving a piece, exchanging one for one, or two for one
either way, raises the sum of squared fill, until sequences have nothing left.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsengine.llm.tokens import encoder, ids_crc32
from obsengine.session import materialize

#: Pieces that one task packs together; a shard wastes about half a sequence.
SHARD = 20_000
#: Pairs of sequences that the search of a shard compares at least; five per piece in large shards.
#: It bounds the time of the search, not what is packed.
EFFORT = 20_000


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter than ``capacity``."""
    first = length % capacity or capacity
    if length <= capacity:
        return [(0, length)]
    return [(0, first), *((at, capacity) for at in range(first, length, capacity))]


def pieces(docs: DataFrame, path: str, *, spaced: bool = True, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and a number of its own."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, spaced).encode
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            index, found = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(encode(text or ""), np.uint32(end_id))
                for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                    index.append(i)
                    found.append((piece, start, length, ids_crc32(ids[start : start + length]), number))
                    number += 1
            columns = list(zip(*found, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(index, pa.int64())), pa.array(columns[0], pa.int32()),
                    *(pa.array(c, pa.int64()) for c in columns[1:]),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "number"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        rows, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, number bigint"
    )


class _Bins:
    """Sequences of one shard: members and free room, with an index of bins by room."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.members: list[list[int]] = []
        self.room: list[int] = []

    def best_fit(self) -> None:
        """Longest first, each into the fullest sequence that still has room."""
        by_room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        present = 0  # bit r is set if some bin has room r
        for item in sorted(range(len(self.sizes)), key=lambda i: (-self.sizes[i], i)):
            size = self.sizes[item]
            fitting = present >> size
            if fitting:
                room = size + (fitting & -fitting).bit_length() - 1
                b = by_room[room].pop()
                if not by_room[room]:
                    present ^= 1 << room
            else:
                b, room = len(self.members), self.capacity
                self.members.append([])
                self.room.append(room)
            self.members[b].append(item)
            self.room[b] = left = room - size
            if left:
                by_room[left].append(b)
                present |= 1 << left

    def search(self) -> None:
        """Exchange pieces between underfull bins, raising the sum of squared fills, until bins empty.

        Every pass lets each underfull bin, emptiest first, hand pieces to every
        other one, fullest first. It goes on while a pass improves anything and
        fewer bins could do; :data:`EFFORT` bounds the comparisons of bins.
        """
        least = -(-sum(self.sizes) // self.capacity)
        left = max(EFFORT, 5 * len(self.sizes))
        live = sum(map(bool, self.members))
        improved = True
        while improved and live > least:
            improved = False
            under = sorted((b for b, m in enumerate(self.members) if m and self.room[b]), key=lambda b: (-self.room[b], b))
            for donor in under:
                for taker in reversed(under):
                    left -= 1
                    if left < 0 or live <= least:
                        return
                    while taker != donor and self.members[donor] and self.members[taker] and self._exchange(donor, taker):
                        improved = True
                        live -= not self.members[donor]
                    if not self.members[donor]:
                        break

    def _exchange(self, donor: int, taker: int) -> bool:
        """The exchange that gives the taker most tokens, if it raises the sum of squares.

        A gain of g does if the taker ends up fuller than the donor was:
        (t + g)^2 + (d - g)^2 > t^2 + d^2 exactly if t + g > d.
        """
        room, sizes = self.room[taker], self.sizes
        more_than = max(0, room - self.room[donor])  # d - t
        if more_than >= room:
            return False
        mine = sorted(self.members[donor], key=sizes.__getitem__)
        theirs = sorted(self.members[taker], key=sizes.__getitem__)
        best, chosen = more_than, None
        two = lambda items: [(x, y) for i, x in enumerate(items) for y in items[:i]]
        ways = [([(x,) for x in mine], [(), *((x,) for x in theirs), *two(theirs)]), (two(mine), [(x,) for x in theirs])]
        weight = lambda items: sum(sizes[i] for i in items)
        for given, taken in ways:
            taken = sorted(taken, key=weight)
            weights = [weight(t) for t in taken]
            for come in given:
                size = weight(come)
                at = bisect_left(weights, size - room)  # the lightest return that leaves room
                if at < len(taken) and size - weights[at] > best:
                    best, chosen = size - weights[at], (come, taken[at])
        if chosen is None:
            return False
        come, gone = chosen
        self.members[donor] = [i for i in self.members[donor] if i not in come] + list(gone)
        self.members[taker] = [i for i in self.members[taker] if i not in gone] + list(come)
        self.room[donor] += best
        self.room[taker] -= best
        return True


def pack_sizes(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers, none over ``capacity``; every item is in exactly one bin."""
    bins = _Bins(sizes, capacity)
    bins.best_fit()
    bins.search()
    return [members for members in bins.members if members]


def pack(docs: DataFrame, path: str, *, spaced: bool = True, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece.

    A null text counts as empty, so it is one piece with the end id alone.
    Null and repeated ids are packed like any row. Shards are dealt by hash of
    the piece's own number and sized from the counted rows, so equal documents
    do not meet in one task.
    """
    found = materialize(pieces(docs, path, spaced=spaced, end_id=end_id, capacity=capacity), "pieces")
    full = found.filter(F.col("length") == capacity)
    rest = found.filter(F.col("length") < capacity)
    shards = max(1, -(-rest.count() // SHARD))

    def pack_shard(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("number", kind="stable").reset_index(drop=True)
        sequence = np.zeros(len(frame), np.int64)
        offset = np.zeros(len(frame), np.int64)
        for b, members in enumerate(pack_sizes(frame["length"].tolist(), capacity)):
            at = 0
            for item in members:
                sequence[item], offset[item] = b, at
                at += int(frame["length"].iat[item])
        # Even numbers; full pieces have odd ones.
        return pd.DataFrame({"number": frame["number"], "sequence_id": 2 * (sequence * shards + int(key[0])), "offset": offset})

    dealt = rest.select("number", "length", F.pmod(F.xxhash64("number"), F.lit(shards)).alias("shard"))
    placed = dealt.groupBy("shard").applyInPandas(pack_shard, "number bigint, sequence_id bigint, offset bigint")
    columns = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    whole = full.withColumn("sequence_id", 2 * F.col("number") + 1).withColumn("offset", F.lit(0).cast("long"))
    return rest.join(placed, "number").select(*columns).union(whole.select(*columns))
