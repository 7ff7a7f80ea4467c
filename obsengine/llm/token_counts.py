"""Exact token counts of whole texts by byte-pair merging, without making identifiers.

A text is cut as a byte-level file says: first at the strings of its added
tokens, each of which is one token, then into white space and words, then by
the file's pattern. The bytes of a part are the first symbols of a linked list,
and a heap holds its adjacent pairs by merge rank. Each merge of the pair of
lowest rank takes one symbol away, so the count is the number of bytes minus
the number of merges.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The characters with the Unicode property White_Space.
_WHITE = "\t-\r \x85\xa0  -     　"
#: White space and words; the last space before a word goes with it. No part of
#: the pattern below lies on both sides of such a cut.
_PIECES = re.compile(f" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]")
#: Fixed value: the pattern of byte-level files.
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+")
#: Heap entries are rank << _PLACE | place, names of symbols are below 1 << _NAME.
_PLACE, _NAME = 40, 24
_AT = (1 << _PLACE) - 1


def byte_letters() -> list[str]:
    """The printable character by which byte-level files write each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    letters |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in letters)}
    return [letters[b] for b in range(256)]


class MergeTable:
    """Merge ranks by pairs of numbered symbols; symbol b is byte b.

    A merge whose sides are not symbols yet names them; equal strings are one symbol.
    """

    def __init__(self, merges: list[tuple[str, str]]):
        names = {letter: b for b, letter in enumerate(byte_letters())}
        self._ranks: dict[int, int] = {}
        self._joint: list[int] = []
        for rank, (left, right) in enumerate(merges):
            a, b, both = (names.setdefault(s, len(names)) for s in (left, right, left + right))
            self._ranks[a << _NAME | b] = rank
            self._joint.append(both)
        if len(names) >> _NAME:
            raise ValueError(f"more than {1 << _NAME} symbols")

    def count(self, part: bytes) -> int:
        """Symbols left of the bytes when no adjacent pair can be merged any more."""
        size, rank_of = len(part), self._ranks.get
        # Taken symbols and the one beyond both ends are -1, which no pair has.
        symbols = [*part, -1]
        after, before = [*range(1, size + 1)], [size, *range(size)]
        pairs = enumerate(zip(part, part[1:]))
        heap = [rank << _PLACE | at for at, (a, b) in pairs if (rank := rank_of(a << _NAME | b)) is not None]
        heapify(heap)
        merges = 0
        while heap:
            entry = heappop(heap)
            at, rank = entry & _AT, entry >> _PLACE
            gone = after[at] if symbols[at] >= 0 else size
            if rank_of(symbols[at] << _NAME | symbols[gone]) != rank:  # a side was merged meanwhile
                continue
            merges += 1
            joint = self._joint[rank]
            symbols[at], symbols[gone] = joint, -1
            ahead, then = before[at], after[gone]
            after[at], before[then] = then, at
            if (rank := rank_of(joint << _NAME | symbols[then])) is not None:
                heappush(heap, rank << _PLACE | at)
            if (rank := rank_of(symbols[ahead] << _NAME | joint)) is not None:
                heappush(heap, rank << _PLACE | ahead)
        return size - merges


class TokenCounter(dict):
    """Counts of texts by a byte-level tokenizer file.

    As a dictionary it remembers the counts of short pieces, at most ``LIMIT``
    of them, and forgets all when it is full.
    """

    LIMIT, SHORT = 500_000, 40

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        cut, model = described["pre_tokenizer"] or {}, described["model"]
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        if not plain or described["normalizer"] or model["type"] != "BPE" or any(model.get(k) for k in odd):
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        if any(t[k] for t in described["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path} has added tokens that take in what stands around them")
        split = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self._merges = MergeTable([(left, right) for left, right in split])
        # Of two added tokens that start at one place the longer one is taken.
        added = sorted((t["content"] for t in described["added_tokens"]), key=len, reverse=True)
        self._added = re.compile("|".join(map(re.escape, added))) if added else None

    def __missing__(self, piece: str) -> int:
        parts = _PARTS.findall(piece)
        # Words with a mark at the end are many, their parts are fewer.
        found = self._merges.count(piece.encode()) if len(parts) < 2 else sum(map(self.__getitem__, parts))
        if len(piece) <= self.SHORT:
            if len(self) >= self.LIMIT:
                self.clear()
            self[piece] = found
        return found

    def tokens(self, text: str) -> int:
        """The number of tokens of a whole text; strings of added tokens are one token each."""
        marks = 0
        if self._added and self._added.search(text):
            parts = self._added.split(text)
            marks = len(parts) - 1
        else:
            parts = [text]
        return marks + sum(sum(map(self.__getitem__, _PIECES.findall(part))) for part in parts)


_counters: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    """The worker's counter for a file; workers are reused, so its memory serves later tasks too."""
    if path not in _counters:
        _counters[path] = TokenCounter(path)
    return _counters[path]


def token_count(path: str) -> Callable[[Column], Column]:
    """A function of a text column: its number of tokens by the byte-level file ``path``.

    The file must be at that path on every machine. Only the text column goes
    through Arrow; all other columns stay where they are, whatever their names.
    A null or empty text has 0 tokens. Equal texts have equal counts, rows are
    neither added nor dropped, and a text is counted whole however long it is.
    """

    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = counter(path).tokens
        for texts in batches:
            yield pa.array([tokens(t.as_py()) if t.is_valid else 0 for t in texts], pa.int64())

    return F.arrow_udf(counts, T.LongType())
