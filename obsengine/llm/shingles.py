"""Word shingles as sorted arrays of 64-bit hashes."""

import numpy as np
import xxhash

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def words(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space (space, U+0009 to U+000D); none for null."""
    return text.split() if text else []


def word_hashes(found: list[bytes]) -> np.ndarray:
    """64-bit hash of each word; hashing anew is faster than asking a dictionary of many words."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def combine(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` successive entries."""
    n = len(hashes) - size + 1
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total = total * _FACTOR + hashes[i : i + n]
    total ^= total >> np.uint64(29)
    total *= _MIX
    return total ^ (total >> np.uint64(32))


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in ascending order, as ``np.unique`` has them but sorted once, without a hash table."""
    values = np.sort(values)
    first = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=first[1:])
    return values[first]


def shingle_set(text: bytes | None, size: int = 5) -> np.ndarray:
    """Distinct shingles of the text with A-Z lower-cased; all words as one if fewer than ``size``."""
    found = words(text.lower() if text else None)
    if not found:
        return np.empty(0, np.uint64)
    return distinct(combine(word_hashes(found), min(size, len(found))))
