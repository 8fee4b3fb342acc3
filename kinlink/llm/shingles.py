"""Vectorised 64-bit hashes of words and of word shingles."""

from __future__ import annotations

import numpy as np

# A-Z to a-z, and the six white-space characters to a space.
LOWER = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MORE = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], dtype=np.uint64)
CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MORE[0]
    x = x ^ (x >> np.uint64(27))
    x = x * _MORE[1]
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: bytes) -> np.ndarray:
    """Hashes of the words of a piece of text whose white space is spaces."""
    raw = np.frombuffer(data, dtype=np.uint8)
    word = np.empty(len(raw) + 2, dtype=bool)
    word[0] = word[-1] = False
    word[1:-1] = raw != 32
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    lengths = ends - starts
    powers = np.full(int(lengths.max()), _BASE, dtype=np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    total = int(lengths.sum())
    at = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    values = (raw[word[1:-1]].astype(np.uint64) + np.uint64(1)) * powers[at]
    return mix(np.add.reduceat(values, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64) * _MORE[2])


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words of a text of any length, a chunk at a time."""
    data = text.encode("utf-8", "surrogatepass").translate(LOWER)
    if len(data) <= CHUNK:
        return _word_hashes(data)
    parts, at = [], 0
    while at < len(data):
        end = data.find(b" ", at + CHUNK)
        end = len(data) if end < 0 else end
        parts.append(_word_hashes(data[at:end]))
        at = end
    return np.concatenate(parts)


def shingle_set(text: str | None, k: int = 5) -> np.ndarray:
    """The sorted distinct hashes of the shingles of ``k`` words; of a shorter text, one of all its words; of none, none."""
    w = word_hashes(text) if text else np.empty(0, dtype=np.uint64)
    if not len(w):
        return w
    n = min(k, len(w))
    h = np.full(len(w) - n + 1, np.uint64(n), dtype=np.uint64)
    for i in range(n):
        h = mix(h ^ w[i : len(w) - n + 1 + i]) * _MORE[3] if i else h + w[i : len(w) - n + 1 + i] * _MORE[4]
    return np.unique(mix(h))
