"""Token ids of whole texts by the public tokenizer files, in tasks.

The library encodes each distinct piece of text once per worker: texts are cut
where its own splitting can't join what stands on both sides, so that ids of
the pieces, put together, are the ids of the text.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array

import numpy as np

#: White space outside ASCII, and ASCII controls that libraries class differently.
_UNCLEAR = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -‍ -  ⁠　﻿]")
_CONTROLS = "\x1c\x1d\x1e\x1f"
#: How the byte-level file cuts white space: the last space before a word goes with the word.
_RUNS = re.compile(r" ?[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+(?![^ \t\n\r\x0b\x0c])|[ \t\n\r\x0b\x0c]+")
_LINES = re.compile("(\n+)")
_ODD = ("  ", " \n", "\n ", "\t", "\r", "\x0b", "\x0c")
#: Pieces of printable ASCII and Latin letters, for which the splits below are those of the files.
_PLAIN = re.compile(" ?[!-~\xc0-\u012f\u0131-\u017f]+").fullmatch
_LETTER = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u017f"
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
_SPACED_SPLIT = re.compile(f"{_ENDINGS}| ?[{_LETTER}]+| ?[0-9]+| ?[^ {_LETTER}0-9]+").findall
_LOWER_SPLIT = re.compile(f"{_ENDINGS}|[{_LETTER}]+|[0-9]|[^ {_LETTER}0-9]+").findall


def _byte_letters() -> dict[int, str]:
    """The printable character by which byte-level files write each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


_BYTES = _byte_letters()


class _Known(dict):
    """Ids of pieces as bytes, computed when first asked for; forgets all when it is full."""

    def __init__(self, compute, limit: int):
        self._compute, self._limit = compute, limit

    def __missing__(self, piece: str) -> bytes:
        found = self._compute(piece)
        if len(self) >= self._limit:
            self.clear()
        self[piece] = found
        return found


class PieceEncoder:
    """Ids of texts by a tokenizer file, each distinct piece encoded once while it is remembered.

    ``spaced``: whether the file is byte-level and keeps white space; otherwise
    it lower-cases and drops white space. The library's model encodes what the
    file's pattern cuts out; a piece with other letters, and a whole text with
    unclear white space or with what looks like a special token, go through
    all of the library. Memory is bounded by ``LIMIT`` pieces of each kind.
    """

    LIMIT = 400_000

    def __init__(self, path: str, spaced: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._spaced = spaced
        self._cut_out = _Known(self._by_model, self.LIMIT)
        self._bare = _Known(self._by_piece, self.LIMIT)
        self._after_space = _Known(lambda word: self._by_piece(" " + word), self.LIMIT)

    def largest_id(self) -> int:
        return self._tokenizer.get_vocab_size(with_added_tokens=True) - 1

    def _by_model(self, cut_out: str) -> bytes:
        cut_out = cut_out.encode().decode("latin-1").translate(_BYTES)
        return array("I", [t.id for t in self._model.tokenize(cut_out)]).tobytes()

    def _by_piece(self, piece: str) -> bytes:
        word = piece[piece[:1] == " " :]
        if word.isascii() and word.isalpha():  # most of them: one part, no byte to rewrite
            if not self._spaced:
                piece = piece.lower()
            found = self._cut_out.get(piece)
            if found is None:
                shown = piece.replace(" ", _BYTES[32])
                found = array("I", [t.id for t in self._model.tokenize(shown)]).tobytes()
            return found
        if word.isascii() and word[:-1].isalpha() and "!" <= word[-1] <= "~" and not word[-1].isdigit():
            # A word and one mark after it, which all patterns cut there.
            if not self._spaced:
                piece = piece.lower()
            return self._cut_out[piece[:-1]] + self._cut_out[piece[-1]]
        if not _PLAIN(piece):
            return self._by_library(piece)
        parts = _SPACED_SPLIT(piece) if self._spaced else _LOWER_SPLIT(piece.lower())
        return b"".join(map(self._cut_out.__getitem__, parts))

    def _by_library(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        """The ids as little-endian unsigned 32-bit integers."""
        return np.frombuffer(self._packed(text), "<u4")

    def _packed(self, text: str) -> bytes:
        # In ASCII only four controls are unclear; a search for each is much faster than one for the class.
        unclear = any(c in text for c in _CONTROLS) if text.isascii() else _UNCLEAR.search(text)
        if unclear or any(s in text for s in self._special):
            return self._by_library(text)
        if not self._spaced:
            return b"".join(map(self._bare.__getitem__, text.split()))
        if any(odd in text for odd in _ODD) or text[:1] == " " or text[-1:] == " ":
            return b"".join(map(self._bare.__getitem__, _RUNS.findall(text)))
        out: list[bytes] = []
        cut = _LINES.split(text)
        for i, part in enumerate(cut):
            if i % 2 == 0:
                if part:
                    first, *rest = part.split(" ")
                    out.append(self._bare[first])
                    out.extend(map(self._after_space.__getitem__, rest))
            elif cut[i + 1]:  # the line break before a word stands alone
                if len(part) > 1:
                    out.append(self._bare[part[1:]])
                out.append(self._bare["\n"])
            else:
                out.append(self._bare[part])
        return b"".join(out)


_encoders: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, spaced: bool) -> PieceEncoder:
    """The worker's encoder for a file; workers are reused, so its memory serves later tasks too."""
    if (path, spaced) not in _encoders:
        _encoders[path, spaced] = PieceEncoder(path, spaced)
    return _encoders[path, spaced]


def ids_crc32(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
