"""Offset-preserving encoding and decoding with a SentencePiece BPE model.

Normalisation takes the longest prefix that the model's compiled character map
knows, step by step, and notes where in the source every character of the
normalised text begins. Pieces of the normalised text are thereby projected to
byte spans of the source.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 bytes, and the replacements it points to."""

    def __init__(self, blob: bytes):
        (size,) = struct.unpack_from("<I", blob)
        self._units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self._strings = blob[4 + size :]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, source: bytes, at: int) -> tuple[int, str] | None:
        """(bytes taken, replacement) of the longest key that begins at ``at``."""
        units, found = self._units, None
        node = self._offset(units[0])
        for end in range(at, len(source)):
            node ^= source[end]
            unit = units[node]
            if unit & 0x800000FF != source[end]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = end + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        start = found[1]
        return found[0], self._strings[start : self._strings.index(b"\0", start)].decode()


class PieceModel:
    """Encoder and decoder of one model file; remembers a bounded number of encoded chunks."""

    LIMIT = 300_000

    def __init__(self, proto: bytes):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(proto)
        if model.trainer_spec.model_type != 2 or any(p.type in (4, 5) for p in model.pieces):
            raise ValueError("only BPE models without user-defined or unused pieces are read")
        spec = model.normalizer_spec
        self._map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self._dummy, self._squeeze, self._escape = (
            spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces,
        )
        self._ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == 1}
        self._scores = {p.piece: p.score for p in model.pieces if p.type == 1}
        bytes_of = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == 6}
        self._byte_ids = bytes_of if model.trainer_spec.byte_fallback else {}
        self._unknown = model.trainer_spec.unk_id
        # What each id decodes to: control pieces to nothing, byte pieces to their byte.
        self._shown: list[bytes] = []
        self._is_byte: list[bool] = []
        for p in model.pieces:
            text = p.piece.replace(SPACE, " ").encode()
            if p.type == 2:
                text = model.trainer_spec.unk_surface.encode()
            elif p.type == 3:
                text = b""
            elif p.type == 6:
                text = bytes([int(p.piece[1:-1], 16)])
            self._shown.append(text)
            self._is_byte.append(p.type == 6)
        self._control = {i for i, p in enumerate(model.pieces) if p.type == 3}
        # Merges never join what these cuts part: no piece holds a space sign behind
        # another character, and a line break is in no longer piece.
        longer = [p for p in self._scores if len(p) > 1]
        apart = not any(SPACE in p.lstrip(SPACE) for p in longer)
        lines = not any("\n" in p for p in longer)
        word = f"[^{SPACE}\n]+" if lines else f"[^{SPACE}]+"
        cut = f"{SPACE}*{word}|{SPACE}+" + ("|\n" if lines else "")
        self._cut = re.compile(cut).findall if apart else lambda text: [text]
        self._known: dict[str, tuple[bytes, bytes]] = {}

    # Normalisation

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and the source byte at which each of its characters begins, and the end."""
        if not text:
            return "", np.zeros(1, np.int64)
        if self._map is None and not self._squeeze:
            points = np.frombuffer(text.encode("utf-32-le"), "<u4")
            sizes = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF).astype(np.int64)
            begins = np.concatenate([[0] if self._dummy else [], [0], np.cumsum(sizes)]).astype(np.int64)
            out = (" " if self._dummy else "") + text
            return out.replace(" ", SPACE) if self._escape else out, begins
        return self._by_prefixes(text)

    def _steps(self, source: bytes) -> Iterator[tuple[int, int, str]]:
        at = 0
        while at < len(source):
            found = self._map.longest(source, at) if self._map else None
            if found is None:
                lead = source[at]
                size = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
                found = size, source[at : at + size].decode()
            yield at, found[0], found[1]
            at += found[0]

    def _by_prefixes(self, text: str) -> tuple[str, np.ndarray]:
        source = text.encode()
        out: list[str] = []
        begins: list[int] = []
        consumed = len(source)
        started = not self._squeeze
        after_space = self._squeeze
        space = SPACE if self._escape else " "
        for at, _size, shown in self._steps(source):
            if not started:
                if shown == " ":
                    continue
                started = True
            if not out and self._dummy:
                out.append(space)
                begins.append(at)
                after_space = self._squeeze
            while after_space and shown.startswith(" "):
                shown = shown[1:]
            if shown:
                for c in shown:
                    out.append(space if c == " " else c)
                    begins.append(at)
                after_space = self._squeeze and shown.endswith(" ")
        if self._squeeze:
            while out and out[-1] == space:
                out.pop()
                consumed = begins.pop()
        return "".join(out), np.array([*begins, consumed], np.int64)

    # Encoding

    def _merge(self, text: str) -> list[str]:
        parts = list(text)
        if len(parts) > 64:
            return self._merge_long(parts)
        score = self._scores.get
        none = float("-inf")
        pairs = [score(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs and (best := max(pairs)) != none:
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = score(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = score(parts[i] + parts[i + 1], none)
        return parts

    def _merge_long(self, parts: list[str]) -> list[str]:
        score, n = self._scores, len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            joined = parts[i] + parts[j]
            if joined in score:
                heapq.heappush(heap, (-score[joined], i, j, joined))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, joined = heapq.heappop(heap)
            if not parts[i] or after[i] != j or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j] = joined, ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [p for p in parts if p]

    def _chunk(self, text: str) -> tuple[bytes, bytes]:
        """Ids of a chunk, and the characters that each takes, as packed 32-bit integers."""
        ids: list[int] = []
        sizes: list[int] = []
        for part in self._merge(text):
            found = self._ids.get(part)
            if found is not None:
                ids.append(found)
                sizes.append(len(part))
            elif self._byte_ids:
                # The last byte stands for the character, those before it for nothing.
                codes = part.encode()
                ids += [self._byte_ids[b] for b in codes]
                sizes += [0] * (len(codes) - 1) + [len(part)]
            else:
                ids.append(self._unknown)
                sizes.append(len(part))
        packed = struct.pack(f"<{len(ids)}i", *ids), struct.pack(f"<{len(ids)}i", *sizes)
        if len(text) <= 64:
            if len(self._known) >= self.LIMIT:
                self._known.clear()
            self._known[text] = packed
        return packed

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the source bytes at which each piece begins and ends."""
        normal, begins = self.normalise(text)
        known, chunk = self._known, self._chunk
        found = [known.get(c) or chunk(c) for c in self._cut(normal)] if normal else []
        ids = np.frombuffer(b"".join([f[0] for f in found]), "<i4")
        ends = np.cumsum(np.frombuffer(b"".join([f[1] for f in found]), "<i4"), dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
        return ids, begins[starts], begins[ends]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: bytes that are no UTF-8 become U+FFFD each."""
        listed = ids.tolist()
        skip = next((i for i, x in enumerate(listed) if x not in self._control), len(listed))
        listed = listed[skip:]
        if not listed:
            return ""
        parts = list(map(self._shown.__getitem__, listed))
        for i, part in enumerate(parts):  # the space that encoding has put before the text
            plain = not self._is_byte[listed[i]] and listed[i] != self._unknown
            if not (self._dummy or self._squeeze) or not plain:
                break
            parts[i] = part.lstrip(b" ") if self._squeeze else part.removeprefix(b" ")
            if parts[i] or not self._squeeze:
                break
        try:
            return b"".join(parts).decode()
        except UnicodeDecodeError:
            return self._decode_broken(listed, parts)

    def _decode_broken(self, listed: list[int], parts: list[bytes]) -> str:
        out: list[str] = []
        run = b""
        for x, part in zip([*listed, None], [*parts, b""], strict=True):
            if x is not None and self._is_byte[x]:
                run += part
                continue
            while run:
                for size in (1, 2, 3, 4):
                    try:
                        out.append(run[:size].decode())
                        run = run[size:]
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    run = run[1:]
            out.append(part.decode())
        return "".join(out)


_models: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """The worker's model of a file; workers are reused, and so is what they remember."""
    if path not in _models:
        with open(path, "rb") as file:
            _models[path] = PieceModel(file.read())
    return _models[path]


#: Documents per batch that goes back to Spark, which bounds a worker's memory.
_BATCH = 200


def encode_pieces(docs: DataFrame, path: str, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, ids, begins and ends (bytes of the UTF-8 source, end exclusive), decoded text.

    A null text counts as empty: no ids, and an empty decoded text. Every row
    gives one row; ids may be null or repeat. The file is one that every
    machine has installed.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                part = batch.slice(at, _BATCH)
                found = [model.encode(t or "") for t in part.column(1).to_pylist()]
                offsets = pa.array(np.cumsum([0, *(len(f[0]) for f in found)]), pa.int32())
                lists = [
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([f[k] for f in found]).astype(np.int32)))
                    for k in range(3)
                ]
                shown = pa.array([model.decode(f[0]) for f in found], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *lists, shown], [id_col, "ids", "begins", "ends", "decoded"]
                )

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text).mapInArrow(
        rows, f"`{id_col}` {kind}, ids array<int>, begins array<int>, ends array<int>, decoded string"
    )


def joined_sha256(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()
