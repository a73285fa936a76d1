"""Vectorised text primitives over Arrow batches: UTF-8 bytes in, word and shingle hashes out.

Words are ``[^\\x20\\x09-\\x0D]+`` over UTF-8 bytes with A-Z folded; every separator is ASCII, so
working on bytes equals working on code points. Nothing here loops over words in Python.

Defined results: a null text counts as empty; a text without words has no shingle; a text of one to
four words has one shingle, its whole sequence.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE = 5
M64 = (1 << 64) - 1

IS_SEP = np.zeros(256, bool)
IS_SEP[[32, 9, 10, 11, 12, 13]] = True
IS_WORD = ~IS_SEP


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeded(seed: int, n: int) -> np.ndarray:
    """n fixed 64-bit words from a seed."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * np.uint64(0x9E3779B97F4A7C15))


LONG = 64  # bytes; longer spans are hashed one by one
SEED = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASKS = np.array([M64 >> (64 - 8 * k) if k else 0 for k in range(9)], np.uint64)


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column end to end, and its len + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.type in (pa.string(), pa.large_string()):
        column = column.cast(pa.large_binary())
    elif column.type != pa.large_binary():
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the words; a word never crosses a document's border."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = IS_WORD[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True, long: int = LONG, key: int = 0) -> np.ndarray:
    """64-bit hashes of spans in ascending order.

    Eight bytes at a time go through a mixer that isn't linear in them, so no pattern of the bytes makes
    hashes equal (a polynomial modulo 2**64 has such patterns); spans over `long` bytes go through BLAKE2b.
    Spans that share a hash can still be searched for, as the mixer is known and can be run backwards; with
    a key (not 0) that is drawn when a job begins there is nothing to search beforehand.
    """
    size = ends - starts
    out = mix(size.astype(np.uint64) * SEED + SEED)
    if not len(starts):
        return out
    low, high = int(starts[0]), int(ends.max())
    padded = np.zeros(high - low + 8, np.uint8)
    padded[:-8] = _LOWER[data[low:high]] if fold else data[low:high]
    eight = np.ndarray((high - low + 1,), "<u8", padded, strides=(1,))
    begin = starts - low
    active = np.flatnonzero(size <= long)
    steps = np.full(-(-long // 8) + 1, SEED)
    if key:
        steps = mix(np.arange(1, len(steps) + 1, dtype=np.uint64) * SEED + np.uint64(key))
    done = 0
    while len(active):
        left = size[active] - done
        out[active] = mix((out[active] ^ (eight[begin[active] + done] & _MASKS[np.minimum(left, 8)])) + steps[done // 8])
        active = active[left > 8]
        done += 8
    rest = np.flatnonzero(size > long)
    if len(rest):
        raw = memoryview(padded)
        secret = key.to_bytes(8, "little") if key else b""
        digest = b"".join(blake2b(raw[a:b], digest_size=8, key=secret).digest() for a, b in zip(begin[rest].tolist(), (ends[rest] - low).tolist(), strict=True))
        out[rest] = np.frombuffer(digest, "<u8")
    return out


def words(data: np.ndarray, offsets: np.ndarray, key: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the len + 1 positions at which each document's words begin."""
    starts, ends = word_bounds(data, offsets)
    return hash_spans(data, starts, ends, key=key), np.searchsorted(starts, offsets)


_STEP = [pow(0xC2B2AE3D27D4EB4F | 1, i, 1 << 64) for i in range(64)]


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words inside a document in order, repeats included, and their bounds."""
    count = np.diff(bounds)
    made = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
    out_bounds = np.concatenate([[0], np.cumsum(made)])
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64), out_bounds
    full = np.zeros(max(0, n - size + 1), np.uint64)
    for i in range(size):
        full += hashes[i : n - size + 1 + i] * np.uint64(_STEP[i]) if n >= size else full
    full = mix(full + np.uint64(size))
    out = np.empty(int(out_bounds[-1]), np.uint64)
    long = np.flatnonzero(count >= size)
    if len(long):
        take = np.repeat(bounds[long] - out_bounds[long], made[long])
        to = spread(out_bounds[long], made[long])
        out[to] = full[to + take]
    for d in np.flatnonzero((count > 0) & (count < size)):
        h = np.zeros(1, np.uint64)
        for i, j in enumerate(range(int(bounds[d]), int(bounds[d + 1]))):
            h += hashes[j : j + 1] * np.uint64(_STEP[i])
        out[out_bounds[d]] = mix(h + np.uint64(count[d]))[0]
    return out, out_bounds


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every run, run after run."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return np.arange(total, dtype=np.int64) + shift


def unique_within(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of every document, and their bounds."""
    parts, sizes = [], np.zeros(len(bounds) - 1, np.int64)
    for d, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if b > a:
            part = np.sort(values[a:b])
            if b - a > 1:
                keep = np.empty(b - a, bool)
                keep[0] = True
                np.not_equal(part[1:], part[:-1], out=keep[1:])
                part = part[keep]
            parts.append(part)
            sizes[d] = len(part)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(sizes)])


def shingle_sets(column, size: int = SHINGLE, key: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text of an Arrow column, and their bounds."""
    data, offsets = utf8(column)
    return unique_within(*shingles(*words(data, offsets, key), size))


def slices(batch: pa.RecordBatch, column: str = "text", most: int = 4 << 20):
    """Cuts a batch into slices of about `most` bytes of text, one row at least."""
    n = batch.num_rows
    if not n:
        return
    length = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(length.astype(np.int64))
    at = 0
    while at < n:
        done = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values of a sorted array."""
    if not len(ordered):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return starts, np.diff(np.append(starts, len(ordered)))
