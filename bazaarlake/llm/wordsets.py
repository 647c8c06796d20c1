"""Hashing of words and word shingles in Arrow batches, and walking over sorted groups. Used inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK = 1 << 21
_P = 0x9E3779B97F4A7C15 | 1
_rng = np.random.default_rng(20)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: a bijection whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def run(p: int) -> np.ndarray:
        out = np.full(n, p, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return run(_P), run(pow(_P, -1, 2**64))


def chunks(texts: pa.Array, most: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about ``most`` bytes; a row is never cut. Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words between ``bounds``, where each begins, and the bounds of each part in words."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    word = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    start = np.flatnonzero(word & np.concatenate(([True], ~word[:-1] | edge[1:n])))
    end = np.flatnonzero(word & np.concatenate((~word[1:] | edge[1:n], [True]))) + 1
    power, inverse = _powers(max(CHUNK * 2, 1 << (n + 1).bit_length()))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:n], out=total[1:])
    hashes = mixed((total[end] - total[start]) * inverse[start])
    return hashes, start, np.searchsorted(start, bounds)


def shingles(words: np.ndarray, bounds: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word windows of each part and their bounds; a part of fewer words has one window, all its words."""
    n = len(words)
    size = np.diff(bounds)
    count = np.where(size > 0, np.maximum(size - width + 1, 1), 0)
    out_bounds = np.concatenate(([0], np.cumsum(count)))
    part = np.repeat(np.arange(len(size)), count)
    at = bounds[:-1][part] + np.arange(out_bounds[-1]) - out_bounds[:-1][part]
    end = bounds[1:][part]
    out = np.zeros(len(at), np.uint64)
    for j in range(width):
        inside = at + j < end
        w = words[np.minimum(at + j, max(n - 1, 0))] if n else np.zeros(0, np.uint64)
        out = out * np.uint64(0xD6E8FEB86659FD93) + np.where(inside, w, np.uint64(0))
    return mixed(out), out_bounds


def distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each part sorted and without repeats, and the new bounds."""
    parts, ends = [], [0]
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        v = np.sort(values[a:b])
        if b - a > 1:
            v = v[np.concatenate(([True], v[1:] != v[:-1]))]
        parts.append(v)
        ends.append(ends[-1] + len(v))
    return (np.concatenate(parts) if parts else values[:0]), np.array(ends, np.int64)


def part_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each part modulo 2**64; 0 for an empty one."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def set_keys(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each part's set, the same for equal sets."""
    n = np.diff(bounds).astype(np.uint64)
    first = mixed(part_sums(mixed(values), bounds) + n * np.uint64(_P))
    second = mixed(part_sums(mixed(values ^ np.uint64(0xA0761D6478BD642F)), bounds) ^ n)
    return first.view(np.int64), second.view(np.int64)


def binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The parts as binary values (8 bytes a hash)."""
    data = np.ascontiguousarray(values)
    ends = (bounds * data.itemsize).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)]).cast(pa.binary())


def fixed(values: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    data = np.ascontiguousarray(values)
    ends = np.arange(len(data) + 1, dtype=np.int64) * (data.shape[1] * data.itemsize)
    return pa.Array.from_buffers(pa.large_binary(), len(data), [None, pa.py_buffer(ends), pa.py_buffer(data)]).cast(pa.binary())


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The tables of rows with equal ``keys`` (integers), from batches sorted by them. A group's size is the caller's bound."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [np.asarray(batch.column(k)) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            this = tuple(int(c[a]) for c in cols)
            if this != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = this
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def overlaps(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all intersections of a bounded list of sets, by products of blocks of their membership matrix."""
    m = len(sets)
    out = np.zeros((m, m), np.float64)
    member = np.repeat(np.arange(m), [len(s) for s in sets])
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[code]
    member, code = member[keep], number[code[keep]]
    order = np.argsort(code, kind="stable")
    member, code = member[order], code[order]
    for a in range(0, int(shared.sum()), columns):
        lo, hi = np.searchsorted(code, (a, a + columns))
        block = np.zeros((m, min(columns, int(code[hi - 1]) + 1 - a)), np.float32)
        block[member[lo:hi], code[lo:hi] - a] = 1
        out += block @ block.T
    return out.astype(np.int64)
