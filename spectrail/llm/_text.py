"""Vectorised word and n-gram hashing over Arrow string buffers.

Every function works on whole texts of a slice of a record batch at a time.
Slices are cut between documents, so memory follows ``SLICE_BYTES`` or the
longest single document, never the batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at a time.
SLICE_BYTES = 1 << 20

#: Bytes of a span that are hashed in blocks of eight; longer spans by a digest.
BLOCKWISE = 64

_SEED, _LEFT, _RIGHT = np.uint64(0x5851F42D4C957F2D), np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)

#: The six bytes that separate words: space and 0x09 to 0x0D.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads every input bit over all 64."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch whose texts together stay near ``limit`` bytes."""
    if not batch.num_rows:
        return
    offsets = _offsets(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def _offsets(array: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type) else np.int32
    return np.frombuffer(array.buffers()[1], kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of len + 1): null texts are empty."""
    if array.null_count:
        array = array.fill_null("")
    offsets = _offsets(array)
    buffer = array.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words of a slice: start, end (byte positions), hash, and the first word of each text."""

    __slots__ = ("data", "end", "first", "hash", "start")

    def __init__(self, array: pa.Array, lower: bool):
        data, offsets = text_bytes(array)
        self.data = data
        n = len(data)
        if not n:
            self.start = self.end = np.zeros(0, np.int64)
            self.hash = np.zeros(0, np.uint64)
            self.first = np.zeros(len(offsets), np.int64)
            return
        solid = ~IS_SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        begins = solid.copy()
        begins[1:] &= ~solid[:-1] | edge[1:n]
        ends = solid.copy()
        ends[:-1] &= ~solid[1:] | edge[1:n]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.hash = span_hash(LOWER[data] if lower else data, self.start, self.end)
        self.first = np.searchsorted(self.start, offsets)

    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes of all words with one space after each, start and end of each word there)."""
        length = self.end - self.start
        end = np.cumsum(length + 1) - 1
        inside = np.ones(int(end[-1]) + 1 if len(end) else 0, bool)
        inside[end] = False
        out = np.full(len(inside), 0x20, np.uint8)
        out[inside] = self.data[~IS_SPACE[self.data]]
        return out, end - length, end


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range: equal bytes, equal hash, wherever they stand.

    Blocks of eight bytes are chained through the finaliser, which is not linear, so no
    pattern of blocks cancels out; spans of over ``BLOCKWISE`` bytes are hashed by a digest.
    """
    if not len(start):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    blocks = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    length = end - start
    h = mix(blocks[start] & _MASKS[np.minimum(length, 8)] ^ _SEED * (length.astype(np.uint64) * np.uint64(2) + np.uint64(1)))
    live, done = np.flatnonzero(length > 8), 8
    while len(live) and done < BLOCKWISE:
        block = blocks[start[live] + done] & _MASKS[np.minimum(length[live] - done, 8)]
        h[live] = mix(h[live] * _LEFT ^ block)
        done += 8
        live = live[length[live] > done]
    for i in live.tolist():
        h[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]], digest_size=8).digest(), "little")
    return h


def same_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, other: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Whether each byte range of ``data`` equals the one of ``other`` beside it."""
    length = end - start
    same = length == stop - begin
    padded, against = (np.concatenate([x, np.zeros(8, np.uint8)]) for x in (data, other))
    a, b = (np.ndarray(len(x) - 7, "<u8", x, strides=(1,)) for x in (padded, against))
    live, done = np.flatnonzero(same & (length > 0)), 0
    while len(live) and done < BLOCKWISE:
        differ = (a[start[live] + done] ^ b[begin[live] + done]) & _MASKS[np.minimum(length[live] - done, 8)] != 0
        same[live[differ]] = False
        done += 8
        live = live[~differ & (length[live] > done)]
    for i in live.tolist():
        same[i] = data[start[i] + done : end[i]].tobytes() == other[begin[i] + done : stop[i]].tobytes()
    return same


def gram_hash(words: np.ndarray, at: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """Hash of ``length`` consecutive word hashes from each position in ``at``, by halves of powers of two."""
    length = np.broadcast_to(np.asarray(length, np.int64), at.shape)
    h, place = mix(length.astype(np.uint64) + _SEED), at.astype(np.int64)
    level, width, most = words, 1, int(length.max(initial=0))
    while width <= most:
        part = np.flatnonzero(length & width)
        h[part] = mix(h[part] * _LEFT + level[place[part]] * _RIGHT)
        if len(part) < len(place):
            place = place.copy()
            place[part] += width
        else:
            place = place + width
        if 2 * width <= most:
            level = mix(level[:-width] * _LEFT + level[width:] * _RIGHT)
        width *= 2
    return h


def digest(raw: bytes | memoryview) -> bytes:
    """16 bytes that stand for a byte string: a cryptographic digest, so equal ones mean equal strings."""
    return hashlib.blake2b(raw, digest_size=16).digest()


def halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Digests as two columns of longs."""
    pairs = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def ranges(start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, position) of every element of the ragged ranges start[i] .. start[i] + count[i]."""
    owner = np.repeat(np.arange(len(start)), count)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return owner, np.repeat(start, count) + within


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
