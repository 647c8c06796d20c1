"""Near-duplicate lines by an exact set-similarity join on their words.

A line is its set of words. Words are ordered by rarity; two sets of Jaccard similarity t or more share a word among their
first n - overlap + 1 words in that order (prefix filter). Lines that share one are compared by size (length filter), by how
many words can still be shared from that place on (positional filter) and by sketches: counts of a set's words in 21 buckets, or 42
for long sets, modulo 8, which never differ by more than the sets do; what is left is verified on the sets. All filters are
exact: they lose no pair.

Rarity comes from counts over the whole corpus, kept in a table of 2^24 buckets (a bounded size, so it may be broadcast);
words sharing a bucket only look more frequent than they are. A second table of the same size counts words in prefixes: a word in
one prefix only makes no pair, and words in very many are dealt out as pairs of blocks, so that no task compares
more than two blocks. Equal sets count as one throughout.

The rows that are dealt by prefix word are six numbers each. One is the word before it in the set's order: two sets
that share this one as well have already met under it. Sets that pass the filters under a word are parted into linked
groups; a group that comes up under several words is verified once. Only then do the words of a set travel, five bytes each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import fresh, row_name, small, stored, table
from bazaarlake.llm.wordsets import binaries, chunks, mixed, overlaps, set_keys, word_hashes

THRESHOLD, LEAST = 0.8, 1
ALIKE = 4  # words of the smallest set that can be near another one (4 of 5 words); smaller ones match their equals only
BITS, SEGMENT_BITS = 24, 16
BLOCK = 1024
_HASH_BITS, _LEVEL_BITS, _RUN = 38, 6, 1 << 19
_TOKEN, _HASH = np.uint64((1 << (_HASH_BITS + _LEVEL_BITS)) - 1), np.uint64((1 << _HASH_BITS) - 1)
_BYTES = 5  # hold a hash
_SPARE = 64 - 8 * _BYTES
_GROUP = np.uint64(_SPARE)

SKETCH = "segment int, at binary, n binary"
LINE = "k1 long, k2 long, rid long, line int"
#: k is 40 bits of k1: sets that share them only mean more to verify. k and ``before`` begin with zero bytes, next to others.
MEMBER = "k long, counts long, halves long, g long, before long, at long"
_APART, _SIDE, _POS, _SIZE = 1, 0, 2, 32  # bits of ``at``: pair of blocks, which of them, position, size
_SEEN = 1 << 20
_FIELDS, LONG = 21, 64  # buckets of a sketch, three bits each; sets of LONG words or more have a second one, of half buckets
_LOW = np.uint64(sum(1 << 3 * i for i in range(_FIELDS)))
_HIGH = _LOW << np.uint64(2)
_SKETCHED, _PAIRS = 1 << 14, 1 << 10  # sets sketched and pairs verified at a time
_CHUNK = 1 << 18  # bytes of text at a time: arrays that fit the cache


def overlap_needed(n, m):
    """Shared words that sets of n and m words need for the threshold."""
    return np.ceil(THRESHOLD / (1 + THRESHOLD) * (n + m) - 1e-9).astype(np.int64)


def prefix_length(n: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Words of a set of n to look at: any partner has at least ``least`` and t * n words. None if only equal sets match."""
    fewest = np.maximum(np.ceil(THRESHOLD * n - 1e-9), least)
    return np.where(n < ALIKE, 0, n - overlap_needed(n, fewest) + 1)


def split_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds of the lines of all texts, and each line's text and number therein."""
    ends = np.flatnonzero(data == 0x0A) + 1
    bounds = np.unique(np.concatenate((offsets, ends)))
    starts = bounds[:-1]
    text = np.searchsorted(offsets, starts, "right") - 1
    first = np.searchsorted(starts, offsets[text])
    return bounds, text, np.arange(len(starts)) - first


def line_sets(batches: Iterator[pa.RecordBatch], levels: np.ndarray | None, least: int = LEAST) -> Iterator[tuple]:
    """(rid, line, tokens, bounds) of lines of ``least`` (1 or more) distinct words or more; a set's tokens are in order of rarity.

    A token is a word's level (a logarithm of its count) before 38 bits of its hash.
    """
    for batch in batches:
        rids = np.asarray(batch.column("rid"))
        for a, _, data, offsets in chunks(batch.column("text"), _CHUNK):
            bounds, text, line = split_lines(data, offsets)
            if len(bounds) < 2:
                continue
            words, _, bounds = word_hashes(data, bounds)
            many = np.flatnonzero(np.diff(bounds) >= least)
            for lo in range(0, len(many), _RUN):
                some = many[lo : lo + _RUN]
                n = bounds[some + 1] - bounds[some]
                ends = np.cumsum(n)
                at = np.repeat(bounds[some] - (ends - n), n) + np.arange(n.sum())
                w = words[at]
                level = levels[w >> np.uint64(64 - BITS)].astype(np.uint64) if levels is not None else np.uint64(0)
                token = (level << np.uint64(_HASH_BITS)) | (w >> np.uint64(64 - _HASH_BITS))
                key = np.sort((np.repeat(np.arange(len(some)), n).astype(np.uint64) << np.uint64(_HASH_BITS + _LEVEL_BITS)) | token)
                key = key[np.concatenate(([True], key[1:] != key[:-1]))]
                of = (key >> np.uint64(_HASH_BITS + _LEVEL_BITS)).astype(np.int64)
                size = np.bincount(of, minlength=len(some))
                enough = size >= least
                key, size, some = key[enough[of]] & _TOKEN, size[enough], some[enough]
                if len(some):
                    yield rids[a + text[some]], line[some], key, np.concatenate(([0], np.cumsum(size)))


def _counted(values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A table of counts as rows of a segment's non-zero places and their counts."""
    rows = []
    for segment in range(len(values) >> SEGMENT_BITS):
        part = values[segment << SEGMENT_BITS : (segment + 1) << SEGMENT_BITS]
        at = np.flatnonzero(part)
        if len(at):
            rows.append((segment, at.astype(np.uint16).tobytes(), part[at].tobytes()))
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)],
            names=["segment", "at", "n"],
        )


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences; any order will do as long as all lines follow the same one."""
    total = np.zeros(1 << BITS, np.uint32)
    for batch in batches:
        for _, _, data, offsets in chunks(batch.column("text"), _CHUNK):
            words, _, _ = word_hashes(data, split_lines(data, offsets)[0])
            np.add.at(total, (words >> np.uint64(64 - BITS)).astype(np.int64), np.uint32(1))
    yield from _counted(total)


def _summed(codes):
    """Sums the rows of each segment, one after the other, and packs a byte per place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([codes(total).tobytes()], pa.binary())], names=["segment", "codes"])

        for batch in batches:
            for segment, at, n in zip(*(batch.column(c).to_pylist() for c in ("segment", "at", "n")), strict=True):
                if segment != now:
                    if now is not None:
                        yield done()
                    now, total = segment, np.zeros(1 << SEGMENT_BITS, np.uint64)
                total[np.frombuffer(at, np.uint16)] += np.frombuffer(n, np.uint32)
        if now is not None:
            yield done()

    return run


def _levels(total: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(3 * np.log2(np.maximum(total, 1))), (1 << _LEVEL_BITS) - 1).astype(np.uint8)


def _blocks(total: np.ndarray, block: int) -> np.ndarray:
    """0 for words in at most one prefix, else 1 + the logarithm of the number of blocks."""
    blocks = np.ceil(np.log2(np.maximum(np.ceil(total / block), 1)))
    return np.where(total > 1, 1 + blocks, 0).astype(np.uint8)


def _broadcast(counts: DataFrame, codes):
    """The summed table as one array of 2^24 bytes, broadcast."""
    dealt = counts.repartition("segment").sortWithinPartitions("segment")
    rows = dealt.mapInArrow(_summed(codes), "segment int, codes binary").collect()
    out = np.zeros(1 << BITS, np.uint8)
    for r in rows:
        out[r["segment"] << SEGMENT_BITS : (r["segment"] + 1) << SEGMENT_BITS] = np.frombuffer(r["codes"], np.uint8)
    return counts.sparkSession.sparkContext.broadcast(out)


def _prefixes(token: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in token, set, position) of prefix words that occur more than once in the corpus."""
    size = np.diff(bounds)
    of = np.repeat(np.arange(len(size)), size)
    pos = np.arange(len(token)) - bounds[:-1][of]
    at = np.flatnonzero((pos < prefix_length(size, least)[of]) & (token >> np.uint64(_HASH_BITS) > 0))
    return at, of[at], pos[at]


def _place(token: np.ndarray) -> np.ndarray:
    return ((token & _HASH) >> np.uint64(_HASH_BITS - BITS)).astype(np.int64)


class _Leads:
    """Which sets of a run speak for their equals: one of each in the run, and none that the task has just seen.

    What was seen is a table of fixed size that forgets, so an equal set may come again; the receiver drops it.
    """

    def __init__(self):
        self.seen = np.zeros(_SEEN, np.int64)

    def __call__(self, k1: np.ndarray) -> np.ndarray:
        _, first = np.unique(k1, return_index=True)
        slot = k1[first] & (_SEEN - 1)
        first, slot = first[self.seen[slot] != k1[first]], slot[self.seen[slot] != k1[first]]
        self.seen[slot] = k1[first]
        lead = np.zeros(len(k1), bool)
        lead[first] = True
        return lead


def _lines_and_counts(levels, least: int):
    """Rows of two kinds: each line's set key, and the counts of words in prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, leads = np.zeros(1 << BITS, np.uint32), _Leads()
        names = [c.split()[0] for c in f"{SKETCH}, {LINE}".split(", ")]
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
        for rid, line, token, bounds in line_sets(batches, levels.value, least):
            k1, k2 = set_keys(token, bounds)
            at, of, _ = _prefixes(token, bounds, least)
            np.add.at(total, _place(token[at[leads(k1)[of]]]), np.uint32(1))
            none = [pa.nulls(len(k1), k) for k in kinds[:3]]
            yield pa.RecordBatch.from_arrays([*none, pa.array(k1), pa.array(k2), pa.array(rid), pa.array(line, pa.int32())], names=names)
        for b in _counted(total):
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.nulls(b.num_rows, k) for k in kinds[3:]]], names=names)

    return run


def _longs(names: list[str], cols: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in cols], names=names)


def _sketches(token: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers of 21 fields for each set: how many words it has in a bucket, and in one half of it, modulo 8. The latter 0 for short sets."""
    size = np.diff(bounds)
    shift = np.arange(_FIELDS, dtype=np.uint64) * np.uint64(3)
    counts, halves = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
    for lo in range(0, len(size), _SKETCHED):
        n = size[lo : lo + _SKETCHED]
        half = ((mixed(token[bounds[lo] : bounds[lo + len(n)]]) >> np.uint64(32)) * np.uint64(2 * _FIELDS)) >> np.uint64(32)
        at = np.repeat(np.arange(len(n)) * 2 * _FIELDS, n) + half.astype(np.int64)
        count = np.bincount(at, minlength=len(n) * 2 * _FIELDS).reshape(len(n), 2, _FIELDS)
        for out, c in ((counts, count.sum(axis=1)), (halves, np.where(n[:, None] >= LONG, count[:, 0], 0))):
            out[lo : lo + len(n)] = np.bitwise_or.reduce((c & 7).astype(np.uint64) << shift, axis=1)
    return counts, halves


def _minus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differences of the fields of two sketches, modulo 8."""
    return ((a | _HIGH) - (b & ~_HIGH)) ^ ((a ^ ~b) & _HIGH)


def _apart(d: np.ndarray) -> np.ndarray:
    """Sum over the fields of a difference of the lesser of d and 8 - d: so many words at least are in one of two sets only."""
    one, two, four = d & _LOW, (d >> np.uint64(1)) & _LOW, (d >> np.uint64(2)) & _LOW
    ones = [np.bitwise_count(x) for x in (one, two, four, one & four, two & four)]  # bytes: the sum is at most 84
    return ones[0] + 2 * ones[1] + 4 * ones[2] - 2 * ones[3] - 4 * ones[4]


def _members(levels, blocks, least: int):
    """A row for each prefix word of a set that other prefixes have too, in every pair of blocks that the set is in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leads = _Leads()
        for _, _, token, bounds in line_sets(batches, levels.value, least):
            k1, _ = set_keys(token, bounds)
            at, of, pos = _prefixes(token, bounds, least)
            code = blocks.value[_place(token[at])]
            keep = leads(k1)[of] & (code > 0)
            at, of, pos, code = at[keep], of[keep], pos[keep], code[keep].astype(np.int64)
            parts = np.int64(1) << (code - 1)
            counts, halves = _sketches(token, bounds)
            block = (mixed(k1.view(np.uint64))[of] >> np.uint64(8)).astype(np.int64) & (parts - 1)
            row = np.repeat(np.arange(len(at)), parts)
            other = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
            own, s = block[row], of[row]
            pair = (np.minimum(own, other) << 32) | np.maximum(own, other)
            group = mixed(token[at][row] ^ mixed(pair.view(np.uint64))) >> _GROUP  # two groups of one number only mean more to compare
            size = np.diff(bounds)[s].astype(np.int64)
            where = (size << _SIZE) | (pos[row].astype(np.int64) << _POS) | ((own != other) << _APART) | (own > other)
            before = np.where(pos > 0, (token[np.maximum(at - 1, 0)] & _HASH) + np.uint64(1), np.uint64(0))[row] << _GROUP
            yield _longs([c.split()[0] for c in MEMBER.split(", ")], [k1[s] << _SPARE, counts[s], halves[s], group, before, where])

    return run


def _most_apart(at_a: np.ndarray, at_b: np.ndarray) -> np.ndarray:
    """Words that may be in one of two similar sets only; -1 where too few are left from the shared word on, or where two blocks meet and both rows are of one."""
    size_a, size_b = at_a >> _SIZE, at_b >> _SIZE
    pos_a, pos_b = (at_a & 0xFFFFFFFF) >> _POS, (at_b & 0xFFFFFFFF) >> _POS
    need = overlap_needed(size_a, size_b)
    within = ((at_a | at_b) & (1 << _APART)) == 0
    ok = (np.minimum(size_a - pos_a, size_b - pos_b) >= need) & (within | (((at_a ^ at_b) & (1 << _SIDE)) != 0))
    return np.where(ok, size_a + size_b - 2 * need, -1)


def _close(a: np.ndarray, b: np.ndarray, most: np.ndarray, counts: np.ndarray, halves: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which pairs of rows differ by at most ``most`` in their sketches."""
    d = _minus(counts[a], counts[b])
    ok = _apart(d) <= most
    fine = np.flatnonzero(ok & (np.minimum(size[a], size[b]) >= LONG))
    half = _minus(halves[a[fine]], halves[b[fine]])
    ok[fine] = _apart(half) + _apart(_minus(d[fine], half)) <= most[fine]
    return ok


def _linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row of each row's component, given linked pairs of n rows."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by group: sets that pass the filters with another one, by the component that these pairs make.

    A component's name is a hash of its sets. Rows are compared with those 1, 2, 3, ... places on in order of size, all groups
    of a run at a time, until the partner is too long.
    """

    def passed(cols: list[np.ndarray]) -> pa.RecordBatch | None:
        k, counts, halves, g, before, at = cols
        n, size, counts, halves = len(g), at >> _SIZE, counts.view(np.uint64), halves.view(np.uint64)
        alive, d, a, b = np.arange(n), 1, [], []
        while True:
            alive = alive[alive + d < n]
            alive = alive[(g[alive] == g[alive + d]) & (size[alive] >= THRESHOLD * size[alive + d] - 1e-9)]
            if not len(alive):
                break
            new = (before[alive] != before[alive + d]) | (before[alive] == 0)  # not met under the word before
            most = np.where(new, _most_apart(at[alive], at[alive + d]), -1)
            ok, most = alive[most >= 0], most[most >= 0]
            ok = ok[_close(ok, ok + d, most, counts, halves, size)]
            a.append(ok)
            b.append(ok + d)
            d += 1
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
        if not len(a):
            return None
        root = _linked(n, a, b)
        own = np.unique(np.concatenate((a, b)))
        name = np.zeros(n, np.uint64)
        np.add.at(name, root[own], mixed(k[own].view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)))
        return _longs(["c", "k"], [name[root[own]], k[own]])

    def sets(cols: list[np.ndarray]) -> list[np.ndarray]:
        k, _, _, g, _, at = cols
        order = np.lexsort((k, at, g))
        cols = [c[order] for c in cols]
        new = np.ones(len(order), bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
        return [c[new] for c in cols]

    held: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [np.asarray(c) for c in batch.columns]
        last = cols[3][-1]
        if held:
            cols = [np.concatenate(pair) for pair in zip(held, cols, strict=True)]
        cols = sets(cols)
        open_ = cols[3] == last  # this group may go on in the next batch
        held = [c[open_] for c in cols]
        out = passed([c[~open_] for c in cols])
        if out:
            yield out
    if held and (out := passed(held)):
        yield out


def _packed(token: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Each part's word hashes, without levels, as a binary value."""
    data = np.ascontiguousarray((token & _HASH).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_BYTES]).ravel()
    return binaries(data, bounds * _BYTES)


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // _BYTES, 8), np.uint8)
    out[:, :_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, _BYTES)
    return out.view("<u8").ravel()


def _payload(levels, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words of the wanted lines of each text."""
        for batch in batches:
            rids = np.asarray(batch.column("rid"))
            wanted = batch.column("wanted")
            key = pa.array(np.arange(batch.num_rows))  # lines are told apart by row, as ids may repeat
            rows = pa.RecordBatch.from_arrays([key, batch.column("text")], names=["rid", "text"])
            lines = np.asarray(wanted.flatten())
            of = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(wanted.offsets)))
            want = (of.astype(np.int64) << 32) | lines
            for row, line, token, bounds in line_sets(iter([rows]), levels.value, least):
                keep = np.isin((row.astype(np.int64) << 32) | line, want)
                if keep.any():
                    size = np.diff(bounds)
                    token = token[np.repeat(keep, size)]
                    ends = np.concatenate(([0], np.cumsum(size[keep])))
                    k1, k2 = set_keys(token, ends)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(k1), pa.array(k2), pa.array(rids[row[keep]]), pa.array(line[keep], pa.int32()), _packed(token, ends)],
                        names=["k1", "k2", "rid", "line", "words"],
                    )

    return run


def _whole(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of batches sorted by ``key``, cut between its groups only."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.asarray(batch.column(key))
        cut = int(np.searchsorted(keys, keys[-1]))
        if held and (cut or held[-1].column(key)[0].as_py() != keys[-1]):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _shared(words: pa.Array, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the sets in rows ``first`` and the rows behind them: how many words both have, and their sizes."""
    both = words.take(pa.array(np.stack((first, first + 1), axis=1).ravel()))
    _, offsets, data = both.buffers()
    bounds = np.frombuffer(offsets, np.int64)[both.offset : both.offset + len(both) + 1] // _BYTES
    size = np.diff(bounds)
    word = _unpacked(data[: int(bounds[-1]) * _BYTES])[bounds[0] :]
    key = np.sort((np.repeat(np.arange(len(first), dtype=np.uint64), size[::2] + size[1::2]) << np.uint64(_HASH_BITS)) | word)
    twice = key[1:][key[1:] == key[:-1]] >> np.uint64(_HASH_BITS)
    return np.bincount(twice.astype(np.int64), minlength=len(first)), size[::2], size[1::2]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per set that is similar to another one of its component: the first line of those sets.

    Most components are two sets; these are verified side by side.
    """

    def similar(shared, size_a, size_b):
        return shared >= THRESHOLD * (size_a + size_b - shared) - 1e-9

    for rows in _whole(batches, "c"):
        g = {c: np.asarray(rows.column(c)) for c in ("c", "rid", "line", "k1", "k2")}
        words = pa.chunked_array([x.cast(pa.large_binary()) for x in rows.column("words").chunks]).combine_chunks()
        cuts = np.flatnonzero(np.concatenate(([True], g["c"][1:] != g["c"][:-1], [True])))
        sets, partners = [], []
        twos = cuts[:-1][np.diff(cuts) == 2]
        for lo in range(0, len(twos), _PAIRS):
            a = twos[lo : lo + _PAIRS]
            a = a[similar(*_shared(words, a))]
            sets += [a, a + 1]
            partners += [a + 1, a]
        for at in np.flatnonzero(np.diff(cuts) > 2).tolist():
            a, b = int(cuts[at]), int(cuts[at + 1])
            some = [_unpacked(x) for x in words[a:b].to_pylist()]
            size = np.array([len(w) for w in some])
            ok = similar(overlaps(some), size[:, None], size[None, :])
            np.fill_diagonal(ok, False)
            order = np.lexsort((g["line"][a:b], g["rid"][a:b]))  # the earliest partner is the first in this order
            rank = ok[:, order]
            has = np.flatnonzero(rank.any(axis=1))
            sets.append(a + has)
            partners.append(a + order[rank[has].argmax(axis=1)])
        has, first = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (sets, partners))
        if len(has):
            yield pa.RecordBatch.from_arrays(
                [pa.array(g["k1"][has]), pa.array(g["k2"][has]), pa.array(g["rid"][first]), pa.array(g["line"][first].astype(np.int32))],
                names=["k1", "k2", "rid", "line"],
            )


def later_matches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(rid, line) of lines that an earlier line matches, in order of rid and place; rid is the row's name, see ``row_name``.

    Lines end at a line feed and are numbered from 0. Lines without words never match. Null and empty texts have no lines to
    match. A row without doc_id goes by a negative hash of its text, so before all others. Rows that agree in id and text are one
    document, whose lines do not match themselves; of an id with several texts, those after the first come behind all other rows.
    """
    docs = row_name(docs.select(doc_id, text), "rid", doc_id, text).select("rid", F.col(text).alias("text"))
    least = LEAST
    levels = _broadcast(docs.mapInArrow(_word_counts, SKETCH), _levels)
    rows = stored(docs.mapInArrow(_lines_and_counts(levels, least), f"{SKETCH}, {LINE}"))
    blocks = _broadcast(rows.where("segment IS NOT NULL").select("segment", "at", "n"), partial(_blocks, block=BLOCK))
    lines = rows.where("segment IS NULL").select("k1", "k2", "rid", "line")
    members = docs.mapInArrow(_members(levels, blocks, least), MEMBER)
    near = members.repartition("g").sortWithinPartitions("g").mapInArrow(_compared, "c long, k long")
    near = stored(near.distinct())
    place = F.struct("rid", "line")
    own = lines.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    k = F.shiftleft("k1", _SPARE)
    own = own.withColumn("k", k).join(near.select("k", F.lit(True).alias("near")).distinct(), "k", "left").drop("k")
    own = stored(own.where("n > 1 OR near"))  # sets that more than one line has, or that are near another one
    wanted = own.where("near").select("k1", "k2", "first.*")
    texts = stored(wanted.groupBy("rid").agg(F.collect_set("line").alias("wanted")))
    texts = small(texts, 1_000_000, F.size("wanted") + 2)  # few numbers: texts stay put
    words = docs.join(texts, "rid").select("rid", "text", "wanted").mapInArrow(_payload(levels, least), f"{LINE}, words binary")
    # Dealt by k once, for the grouping and for the join. A repeated id may bring a set's line in more than once.
    words = words.withColumn("k", k).repartition("k").groupBy("k", "k1", "k2").agg(F.min(place).alias("p"), F.first("words").alias("words"))
    words = words.select("k", "k1", "k2", "p.*", "words")
    similar = near.join(words, "k").drop("k").repartition("c").sortWithinPartitions("c").mapInArrow(_verified, LINE)
    other = similar.groupBy("k1", "k2").agg(F.min(place).alias("other"))
    first = own.join(other, ["k1", "k2"], "left").where("n > 1 OR other IS NOT NULL")
    first = small(stored(first.select("k1", "k2", F.least("first", "other").alias("first"))), 500_000)
    return lines.join(first, ["k1", "k2"]).where(place > F.col("first")).select("rid", "line").distinct()


def removed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(rid, removed): the numbers of each document's removed lines, in order."""
    return later_matches(docs, doc_id, text).groupBy("rid").agg(F.sort_array(F.collect_list("line")).alias("removed"))


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` without the lines that earlier lines match; a document may end up empty. Null texts stay null."""
    rid, removed = fresh(docs, "_rid", "_removed")
    gone = removed_lines(docs.select("doc_id", "text")).select(F.col("rid").alias(rid), F.col("removed").alias(removed))
    left = F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains(F.col(removed), i))
    joined = row_name(docs, rid).join(gone, rid, "left")
    return joined.withColumn("text", F.when(F.col(removed).isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))).select(*docs.columns)


def op2_line_prefix_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    slim = row_name(docs, "rid").select("doc_id", "rid", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"))
    none = F.array().cast("array<int>")
    return slim.join(removed_lines(docs), "rid", "left").select("doc_id", "n_lines", F.coalesce("removed", none).alias("removed_lines"))
