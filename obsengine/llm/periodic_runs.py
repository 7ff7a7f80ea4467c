"""Maximal periodic runs of words, by recompression.

The words of many texts are put into one sequence of numbers, each text ended
by a mark of its own. Rounds of block compression (a stretch of one symbol
becomes one symbol) and pair compression (symbols are split into left and right
ones, and a left one followed by a right one becomes one symbol) make a
run-length grammar whose levels shrink geometrically. Whether two neighbours
are joined depends on these two alone, so equal stretches are cut alike but at
their ends, and two places are compared by climbing while they agree and
descending where they differ: a few steps a level.

A run of period q holds two neighbouring multiples of q that are equal words.
For every q these candidates are extended both ways by such comparisons. Their
number is n log n at most and mostly the share of equal words of that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

LEAST = 12
#: Words put into one grammar; a longer text has one of its own.
BATCH = 1 << 17
#: Candidates that are extended together.
CANDIDATES = 1 << 20
RESULT = "struct<n_words: bigint, runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string>"


def _named(keys: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
    """Equal keys get equal new names, from ``fresh`` on; and the next free name."""
    different, names = np.unique(keys, return_inverse=True)
    return names + fresh, fresh + len(different)


class Level:
    """Symbols of one level and how the next one joins them.

    ``parent[x]`` is the joint symbol of x, ``child[y]`` the first member of
    y, with the length as last entry; ``block`` says whether members are equal.
    """

    def __init__(self, symbols: np.ndarray):
        self.symbols = symbols
        self.parent = self.child = np.zeros(0, np.int64)
        self.block = False

    def joined(self, starts: np.ndarray, block: bool) -> None:
        """Members begin at the places where ``starts`` is true."""
        self.block = block
        self.child = np.append(np.flatnonzero(starts), len(self.symbols))
        self.parent = np.cumsum(starts) - 1

    def mirrored(self) -> Level:
        """The same level read from the right."""
        turned = Level(self.symbols[::-1])
        if len(self.child):
            turned.block = self.block
            turned.child = len(self.symbols) - self.child[::-1]
            turned.parent = len(self.child) - 2 - self.parent[::-1]
        return turned


def recompress(symbols: np.ndarray) -> list[Level]:
    """Levels of the grammar, the given symbols first; negative ones are never joined."""
    levels = [Level(symbols)]
    fresh = int(symbols.max(initial=0)) + 1
    factor = np.uint64(0x9E3779B97F4A7C15)  # an odd multiplier that mixes names
    while True:
        level, now = levels[-1], levels[-1].symbols
        joinable = (now[:-1] >= 0) & (now[1:] >= 0)
        if not joinable.any():  # one symbol is left between two marks
            return levels
        starts = np.append(True, ~joinable | (now[1:] != now[:-1]))
        if not starts.all():
            level.joined(starts, True)
            sizes, heads = np.diff(level.child), now[level.child[:-1]]
            long = sizes > 1
            heads[long], fresh = _named(heads[long] * (len(now) + 1) + sizes[long], fresh)
            levels.append(Level(heads))
            continue
        turn = np.uint64(len(levels))
        right = ((now.astype(np.uint64) + turn) * factor >> np.uint64(40 + len(levels) % 16)) & np.uint64(1) == 1
        pairs = ~right[:-1] & right[1:] & joinable
        starts = np.append(True, ~pairs)
        level.joined(starts, False)
        heads, at = now[level.child[:-1]], np.flatnonzero(pairs)
        heads[level.parent[at]], fresh = _named(now[at] * fresh + now[at + 1], fresh)
        levels.append(Level(heads))


def common(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each pair of places, how many symbols from there on are equal.

    Every pair must differ somewhere before the sequence ends.
    """
    found = np.zeros(len(i), np.int64)
    differing: list[list[tuple]] = []
    who, a, b = np.arange(len(i)), i, j
    for level in levels:  # climb
        differing.append([])
        top = not len(level.child)
        while len(who):
            if not top:
                pa_, pb = level.parent[a], level.parent[b]
                ready = (level.child[pa_] == a) & (level.child[pb] == b)
            else:
                ready = np.zeros(len(a), bool)
            same = level.symbols[a] == level.symbols[b]
            stop = ~ready & ~same
            if stop.any():
                differing[-1].append((who[stop], a[stop], b[stop]))
            go = ~ready & same
            if not go.any():
                break
            step = 1
            if level.block:
                step = np.minimum(level.child[pa_ + 1] - a, level.child[pb + 1] - b)
            left = ready | go
            a, b = np.where(go, a + step, a)[left], np.where(go, b + step, b)[left]
            who = who[left]
        if top or not len(who):
            break
        who, a, b = who[ready], level.parent[a[ready]], level.parent[b[ready]]
    who = a = b = np.zeros(0, np.int64)
    for n in range(len(differing) - 1, -1, -1):  # descend
        level = levels[n]
        if len(who):
            above = a, b
            a, b = level.child[a], level.child[b]
            same = level.symbols[a] == level.symbols[b]
            sizes = np.minimum(*(level.child[x + 1] - level.child[x] for x in above)) if level.block else 1
            a, b = np.where(same, a + sizes, a), np.where(same, b + sizes, b)
        parts = [(who, a, b), *differing[n]]
        who, a, b = (np.concatenate([p[k] for p in parts]) for k in range(3))
    found[who] = a - i[who]
    return found


_grid: dict[str, np.ndarray] = {}


def _small_grid(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(q, right, ends) for places below ``size``: right is a multiple of q, sorted by right.

    The first ``ends[n]`` entries have right < n.
    """
    if len(_grid.get("ends", ())) <= size:
        top = max(1024, 1 << int(size).bit_length())
        q = np.arange(1, top)
        many = (top - 1) // q
        period = np.repeat(q, many)
        right = period * (np.arange(len(period)) - np.repeat(np.cumsum(many) - many, many) + 1)
        order = np.argsort(right, kind="stable")
        _grid["q"], _grid["right"] = period[order].astype(np.int32), right[order].astype(np.int32)
        _grid["ends"] = np.searchsorted(_grid["right"], np.arange(top + 1))
    return _grid["q"], _grid["right"], _grid["ends"]


def _candidates(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(left place, period) of the grid of every text, in bounded blocks."""
    first = 0
    while first < len(sizes):
        if sizes[first] > BATCH:  # one long text: blocks of periods
            n, q = int(sizes[first]), 1
            while 2 * q <= n:
                last = q
                many = 0
                while 2 * last <= n and (not many or many + (n - 1) // last <= CANDIDATES):
                    many += (n - 1) // last
                    last += 1
                periods = np.arange(q, last)
                for lo in range(0, (n - 1) // q, CANDIDATES):
                    k = np.minimum((n - 1) // periods, lo + CANDIDATES) - lo
                    k = np.maximum(k, 0)
                    period = np.repeat(periods, k)
                    step = lo + np.arange(len(period)) - np.repeat(np.cumsum(k) - k, k)
                    yield starts[first] + period * step, period
                q = last
            first += 1
            continue
        q, right, ends = _small_grid(int(sizes[first:].max(where=sizes[first:] <= BATCH, initial=1)))
        many = ends[np.minimum(sizes, BATCH)]
        last, total = first, 0
        while last < len(sizes) and sizes[last] <= BATCH and (not total or total + many[last] <= CANDIDATES):
            total += many[last]
            last += 1
        k = many[first:last]
        entry = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        period = q[entry].astype(np.int64)
        fits = 2 * period <= np.repeat(sizes[first:last], k)
        yield (np.repeat(starts[first:last], k) + right[entry] - period)[fits], period[fits]
        first = last


def runs_of(numbers: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of every run, by text, start and period.

    ``numbers`` are the words of all texts one after the other, none negative;
    ``sizes`` are the texts' numbers of words.
    """
    count = len(sizes)
    # A mark before the first text and after every text.
    starts = np.cumsum(sizes) - sizes + np.arange(count) + 1
    symbols = np.empty(len(numbers) + count + 1, np.int64)
    marks = np.append(0, starts + sizes)
    symbols[marks] = -1 - np.arange(count + 1)
    inside = np.ones(len(symbols), bool)
    inside[marks] = False
    symbols[inside] = numbers
    levels = mirror = None
    found = []
    for left, period in _candidates(starts, sizes):
        equal = symbols[left] == symbols[left + period]
        left, period = left[equal], period[equal]
        if not len(left):
            continue
        if levels is None:
            levels = recompress(symbols)
            mirror = [level.mirrored() for level in levels]
        ahead = common(levels, left, left + period)
        # Where the words ahead end, no more than this can be behind.
        turned = len(symbols) - left
        behind = common(mirror, turned, turned - period)
        length = behind + period + ahead
        good = (length >= 2 * period) & (length >= LEAST)
        found.append(np.stack([left[good] - behind[good], length[good], period[good]]))
    start, length, period = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    # One stretch has the smallest of its periods.
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1]))[: len(start)]
    start, length, period = start[new], length[new], period[new]
    text = np.searchsorted(starts, start, side="right") - 1
    order = np.lexsort((period, start))
    start, length, period, text = start[order], length[order], period[order], text[order]
    return text, start - starts[text], length, period


def _found(texts: list[bytes]) -> pa.Array:
    """The result for some texts."""
    words = [text.split() for text in texts]  # bytes split at the space and U+0009 to U+000D
    sizes = np.array([len(w) for w in words], np.int64)
    known: dict[bytes, int] = {}
    name = known.setdefault
    numbers = np.fromiter((name(w, len(known)) for text in words for w in text), np.int64, int(sizes.sum()))
    text, start, length, period = runs_of(numbers, sizes)
    ends = np.searchsorted(text, np.arange(len(texts) + 1))
    kept: list[bytes] = []
    for n, parts in enumerate(words):
        if ends[n] < ends[n + 1]:
            cover = np.zeros(len(parts) + 1, np.int64)
            of = slice(ends[n], ends[n + 1])
            np.add.at(cover, start[of] + period[of], 1)
            np.add.at(cover, start[of] + length[of], -1)
            parts = [w for w, c in zip(parts, np.cumsum(cover)) if not c]
        kept.append(b" ".join(parts))
    entries = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], ["start", "length", "period"])
    runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)
    return pa.StructArray.from_arrays(
        [pa.array(sizes), runs, pa.array(kept, pa.binary()).cast(pa.string())], ["n_words", "runs", "collapsed"]
    )


def _blocks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        # A word takes two bytes at least, but about six in most texts.
        parts, held, size = [], [], 0
        for text in batch:
            held.append((text.as_py() or "").encode())
            size += len(held[-1])
            if size >= 6 * BATCH:
                parts.append(_found(held))
                held, size = [], 0
        if held or not parts:
            parts.append(_found(held))
        yield pa.concat_arrays(parts)


def periodic_runs() -> Callable[[Column], Column]:
    """A function of a text column: its number of words, its periodic runs and its words without the repeats.

    Words are maximal stretches of other characters than the space and U+0009
    to U+000D. A run is a stretch of words with smallest period q, so that words
    q apart are equal, of at least 12 and at least 2 q words, which can't be
    made longer with that period. ``runs`` has them by start and period, with
    starts in words from 0. ``collapsed`` has the words that no run holds after
    its first period, joined by one space.

    Null and empty texts have no words, no runs and an empty ``collapsed``.
    Rows are neither added nor dropped; only the text goes through Arrow, so
    other columns may have any names. Texts are taken whole: a text longer than
    a batch has a grammar of its own, and memory follows the longest text.
    """
    return F.arrow_udf(_blocks, RESULT)
