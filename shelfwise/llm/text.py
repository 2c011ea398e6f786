"""Vectorised words, shingles and MinHash over Arrow string columns.

Everything works on one Arrow batch at a time inside a Spark task: the
string buffer is read as bytes, word limits and word hashes come from
numpy passes over it, and shingles and signatures from passes over the
word hashes. No text is cut short.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE = 5            # words of a shingle
SIMILARITY = 0.8       # near-duplicate threshold
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD1B54A32D192ED03)
_CHUNK = 1 << 18       # bytes hashed at a time


def byte_table(members) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


#: Letters and digits of ASCII and every byte of other scripts.
WORD_BYTES = byte_table([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])
#: Everything but ASCII white space.
INK_BYTES = ~byte_table([32, *range(9, 14)])


@dataclass
class Words:
    """Words of a batch: 64-bit hashes, byte limits in the batch's buffer,
    and for document d the words first[d]:first[d + 1]."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    data: np.ndarray
    offsets: np.ndarray


def mix(h: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values (multiply and xor-shift rounds)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, n or more of each. A worker
    keeps those of one chunk; longer runs are made anew."""
    def table(size: int) -> list[np.ndarray]:
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            out.append(np.cumprod(steps, dtype=np.uint64))
        return out
    if n > _CHUNK + 1:
        return tuple(table(n))
    if not _POWERS:
        _POWERS.extend(table(_CHUNK + 1))
    return _POWERS[0], _POWERS[1]


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; nulls are empty texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def cuts_of(texts: pa.Array, most: int = 1 << 20) -> list[tuple[int, int]]:
    """Runs of rows whose texts have at most so many bytes (or are one row)."""
    ends = pc.fill_null(pc.binary_length(texts.cast(pa.large_string())), 0).to_numpy(zero_copy_only=False).cumsum()
    out, at = [], 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        out.append((at, stop))
        at = stop
    return out


def portions(batches, column: str = "text"):
    """Batches cut so that the texts of one are a MB (or one row)."""
    for batch in batches:
        for at, stop in cuts_of(batch.column(column)):
            yield batch.slice(at, stop - at)


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range start:end (ranges in order, none empty):
    differences of prefix sums of a polynomial, a chunk of bytes at a time."""
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        if end[at] - start[at] > _CHUNK:
            out[at] = _long_range(data[start[at]:end[at]])
            at += 1
            continue
        low = start[at]
        stop = max(at + 1, int(np.searchsorted(end, low + _CHUNK, "right")))
        high = end[stop - 1]
        up, down = _powers(high - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up[:high - low], out=sums[1:])
        s, e = start[at:stop] - low, end[at:stop] - low
        out[at:stop] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * _STEP
        at = stop
    return mix(out)


def _long_range(data: np.ndarray) -> np.uint64:
    """The same sum for a range of more than a chunk, a chunk at a time."""
    up, _ = _powers(_CHUNK + 1)
    total, shift = 0, 1
    for at in range(0, len(data), _CHUNK):
        part = data[at:at + _CHUNK].astype(np.uint64) + np.uint64(1)
        total += shift * int((part * up[:len(part)]).sum(dtype=np.uint64))
        shift = shift * pow(_BASE, _CHUNK, 1 << 64) % (1 << 64)
    return np.uint64((total + len(data) * int(_STEP)) % (1 << 64))


def words_of(texts: pa.Array, members: np.ndarray = WORD_BYTES, lower: bool = True) -> Words:
    """Words (longest runs of member bytes) of every text; ``lower`` folds
    case in all scripts first."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if lower:
        texts = pc.utf8_lower(texts.cast(pa.large_string()))
    data, offsets = buffer_of(texts)
    return split_words(data, offsets, members)


def split_words(data: np.ndarray, offsets: np.ndarray, members: np.ndarray) -> Words:
    inside = members[data]
    if not len(data):
        empty = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), empty, empty, np.zeros(len(offsets), np.int64), data, offsets)
    limits = offsets[:-1][offsets[:-1] < len(data)]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[limits] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[limits[limits > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(range_hashes(data, start, end), start, end, np.searchsorted(start, offsets), data, offsets)


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For items with these counts: the owner of each unit and its place."""
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return owner, place


def sentences(w: Words, lines: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(first word of each sentence and the end, document of each sentence).
    A sentence ends at a line's end, or at . ! ? before white space;
    ``lines``: at a line's end only."""
    data = w.data
    def between(members):
        sums = np.concatenate([[0], np.cumsum(byte_table(members)[data], dtype=np.int64)])
        return sums[w.start[1:]] - sums[w.end[:-1]] > 0
    n = len(w.start)
    opens = np.zeros(n, bool)
    if n:
        opens[1:] = between([10, 13])
        if not lines:
            opens[1:] |= between([33, 46, 63]) & between([9, 32])
        opens[w.first[:-1][np.diff(w.first) > 0]] = True
    first = np.flatnonzero(opens)
    return np.r_[first, n], np.searchsorted(w.first, first, "right") - 1


def code_points(data: np.ndarray) -> np.ndarray:
    """Code points that begin before each byte (one entry more than bytes)."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])


def shingles(hashes: np.ndarray, first: np.ndarray, n: int = SHINGLE,
             short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of n-word runs, limits by item). An item of fewer than n words
    has one shingle of all its words (``short``), or none."""
    lengths = np.diff(first)
    counts = np.maximum(lengths - n + 1, np.minimum(lengths, 1) if short else 0)
    owner, place = spread(counts)
    begin = first[:-1][owner] + place
    stop = first[1:][owner]
    out = np.zeros(len(begin), np.uint64)
    step = np.uint64(1)
    for k in range(n):
        at = begin + k
        have = at < stop
        out = out * np.uint64(_BASE) + np.where(have, hashes[np.minimum(at, len(hashes) - 1)] if len(hashes) else 0, step)
    return mix(out), np.concatenate([[0], np.cumsum(counts)])


def grams(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n < SHINGLE words, equal to the one ``shingles``
    gives an item of just these words; limits by item."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    owner, place = spread(counts)
    begin = first[:-1][owner] + place
    out = np.zeros(len(begin), np.uint64)
    for k in range(SHINGLE):
        out = out * np.uint64(_BASE) + (hashes[begin + k] if k < n and len(begin) else np.uint64(1))
    return mix(out), np.concatenate([[0], np.cumsum(counts)])


def sequence_hashes(hashes: np.ndarray, first: np.ndarray, salt: int) -> np.ndarray:
    """64-bit hash of each item's whole word sequence."""
    keyed = mix(hashes ^ np.uint64(salt))
    out = np.zeros(len(first) - 1, np.uint64)
    lengths = np.diff(first)
    full = np.flatnonzero(lengths)
    if len(full):
        _, place = spread(lengths[full])
        up, _ = _powers(int(lengths.max()) + 1)
        index = np.arange(first[0], first[-1]) if len(full) == len(lengths) else np.concatenate(
            [np.arange(first[i], first[i + 1]) for i in full])
        starts = np.cumsum(lengths[full]) - lengths[full]
        out[full] = np.add.reduceat(keyed[index] * up[place], starts)
    return mix(out + lengths.astype(np.uint64) * _STEP)


def pair_keys(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of each item's word sequence, as (items, 2)."""
    return np.stack([sequence_hashes(hashes, first, 0xA5A5 + k) for k in (0, 1)], 1)


def fixed_binary(rows: np.ndarray) -> pa.Array:
    """Each row of a (items, k) array as one binary value of its bytes."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def binary_runs(values: np.ndarray, limits: np.ndarray) -> pa.Array:
    """values[limits[i]:limits[i + 1]] as binary values."""
    offsets = (limits * values.itemsize).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(limits) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(
        np.ascontiguousarray(values))]).cast(pa.binary())


def distinct_runs(values: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run sorted and without repeats: (values, limits)."""
    owner = np.repeat(np.arange(len(limits) - 1), np.diff(limits))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[fresh], np.searchsorted(owner[fresh], np.arange(len(limits)))


def banding(similarity: float, recall: float, most: int = 128) -> tuple[int, int]:
    """(bands, rows): the most rows a band can have so that a pair of just
    that similarity collides with at least that probability, within ``most``
    hashes."""
    for rows in range(most, 0, -1):
        hit = similarity ** rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-hit)) if hit > 1e-12 else most + 1
        if bands * rows <= most:
            return bands, rows
    raise ValueError("no banding reaches this recall within so many hashes")


def minima(values: np.ndarray, limits: np.ndarray, count: int, seed: int = 1) -> np.ndarray:
    """MinHash signatures, shape (items, count); every item needs a value."""
    out = np.empty((count, len(limits) - 1), np.uint64)
    for k, (row,) in minima_rows(values, [limits], count, seed):
        out[k] = row
    return out.T


def minima_rows(values: np.ndarray, limits: list[np.ndarray], count: int, seed: int):
    """(k, the k-th minima of the items of each division); the divisions cut
    the same values at different limits, and every item needs a value."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, (count, 2), dtype=np.uint64)
    keyed = np.empty_like(values)
    for k in range(count):
        np.multiply(values, a[k, 0] * np.uint64(2) + np.uint64(1), out=keyed)
        np.add(keyed, a[k, 1], out=keyed)
        yield k, [np.minimum.reduceat(keyed, cut[:-1]) if len(cut) > 1 else np.zeros(0, np.uint64) for cut in limits]


def band_hashes(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(items, bands) int64 hashes of the signature bands."""
    out = np.empty((len(signatures), bands), np.uint64)
    for j in range(bands):
        h = np.full(len(signatures), j + 1, np.uint64)
        for k in range(j * rows, (j + 1) * rows):
            h = mix(h * np.uint64(_BASE) + signatures[:, k])
        out[:, j] = h
    return out.view(np.int64)


def overlaps(sets: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Sizes of all intersections of these few sets (matrix products over
    blocks of the values)."""
    m = len(sets)
    lengths = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(m), lengths)
    _, value = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(value, kind="stable")
    owner, value = owner[order], value[order]
    out = np.zeros((m, m), np.float64)
    at = 0
    while at < len(value):
        stop = int(np.searchsorted(value, value[at] + columns))
        block = np.zeros((m, int(value[stop - 1] - value[at]) + 1), np.float32)
        block[owner[at:stop], value[at:stop] - value[at]] = 1
        out += block @ block.T
        at = stop
    return out.astype(np.int64)


def runs_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, limits) of binary values that hold 64-bit numbers."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint64), np.zeros(len(column) + 1, np.int64)
    values = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]].copy().view(np.uint64)
    return values, (offsets - offsets[0]) // 8
