"""Words and shingles of whole batches of texts, as numpy arrays over their UTF-8 bytes.

A batch of texts is one byte array with offsets, so tokenising and hashing cost a few
array operations a batch and no Python call per word. Separators are ASCII, which
never occurs inside a multi-byte character, so splitting bytes splits characters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=U64)
_ONE, _TWO, _THREE = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0xD6E8FEB86659FD93)
#: Words of more bytes are hashed one by one.
_LONG = 64

#: Space and the controls U+0009 to U+000D.
WORD_BYTES = np.ones(256, dtype=bool)
WORD_BYTES[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offset of each text; a null is empty."""
    texts = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    all_bytes = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return all_bytes[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(32))) * _THREE
    h ^= h >> U64(29)
    h *= _TWO
    h ^= h >> U64(32)
    return h


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every maximal run of member bytes, never across two texts, and
    the offset of each text's first run."""
    first = member.copy()
    first[1:] &= ~member[:-1]
    last = member.copy()
    last[:-1] &= ~member[1:]
    full = offsets[:-1][offsets[1:] > offsets[:-1]]
    first[full] = member[full]
    ends = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    last[ends] = member[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the offset of each text's first word."""
    return runs(WORD_BYTES[data], offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, eight bytes a round."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    size = ends - starts
    h = mix(size.astype(U64) * _ONE ^ (eight[starts] & _KEEP[np.minimum(size, 8)]))
    at = np.flatnonzero((size > 8) & (size <= _LONG))
    done = 8
    while len(at):
        left = np.minimum(size[at] - done, 8)
        h[at] = mix((h[at] * _ONE) ^ (eight[starts[at] + done] & _KEEP[left]))
        done += 8
        at = at[size[at] > done]
    for i in np.flatnonzero(size > _LONG).tolist():
        h[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes())
    return h


def combine(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive hashes, in order."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.full(n, k, dtype=U64)
    for j in range(k):
        out *= _ONE
        out += h[j : j + n]
        out ^= out >> U64(31)
    return mix(out)


def shingles(h: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every text's k-word shingles, repeats included, and their offsets. A
    text of fewer words is one shingle as a whole; one without words has none."""
    n = np.diff(offsets)
    counts = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    ends = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(n)), counts)
    position = np.arange(ends[-1]) - ends[owner] + offsets[owner]
    rolled = combine(h, k)
    if not len(rolled):
        rolled = np.zeros(1, U64)
    out = rolled[np.minimum(position, len(rolled) - 1)]
    for i in np.flatnonzero((n > 0) & (n < k)).tolist():
        out[ends[i]] = combine(h[offsets[i] : offsets[i + 1]], int(n[i]))[0]
    return out, ends


def char_offsets(data: np.ndarray) -> np.ndarray:
    """The number of characters that begin before each byte, and in all."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
