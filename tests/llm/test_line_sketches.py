"""Sketches of line sets: they lose no pair, and long lines that have little in common do not travel to verification."""

import random
from types import SimpleNamespace

import brute
import numpy as np
import pyarrow as pa

from bazaarlake.llm import line_dedup


def texts(rows):
    return pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows])], names=["rid", "text"])


def compared(rows):
    """Sets that the filters leave, by component, for words that are all as rare."""
    ones = SimpleNamespace(value=np.ones(1 << line_dedup.BITS, np.uint8))
    members = pa.Table.from_batches(line_dedup._members(ones, ones, 1)(iter([texts(rows)]))).sort_by("g").combine_chunks()
    return sum(b.num_rows for b in line_dedup._compared(iter(members.to_batches())))


def changed(rng, words, n):
    gone = set(rng.sample(range(len(words)), n))
    return [f"new{rng.random()}" if i in gone else w for i, w in enumerate(words)]


def test_unrelated_long_lines_are_told_apart():
    rng = random.Random(3)
    pool = [f"w{i}" for i in range(2000)]
    rows = [(i, " ".join(rng.sample(pool, rng.randrange(120, 180)))) for i in range(300)]
    assert compared(rows) == 0
    near = [(i, " ".join(changed(rng, t.split(), 5))) for i, (_, t) in enumerate(rows[:40], 1000)]
    assert compared(rows + near) >= 80


def test_sketches_never_exceed_the_difference():
    rng = random.Random(4)
    pool = [f"w{i}" for i in range(500)]
    sets = [rng.sample(pool, rng.randrange(1, 300)) for _ in range(120)]
    sets += [changed(rng, s, rng.randrange(1 + len(s) // 5)) for s in sets]
    rows = [(i, " ".join(s)) for i, s in enumerate(sets)]
    (_, _, token, bounds), = line_dedup.line_sets(iter([texts(rows)]), None)
    counts, halves = line_dedup._sketches(token, bounds)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    size = np.diff(bounds)
    apart = np.array([len(set(sets[i]) ^ set(sets[j])) for i, j in zip(a, b, strict=True)])
    assert line_dedup._close(a, b, apart, counts, halves, size).all()
    far = apart > 100
    assert line_dedup._close(a[far], b[far], apart[far] // 9, counts, halves, size).mean() < 0.05


def test_long_lines_against_brute_force(spark):
    rng = random.Random(5)
    pool = [f"w{i}" for i in range(900)]
    lines = [rng.sample(pool, n) for n in (5, 20, 55, 60, 63, 64, 65, 70, 90, 130, 170, 260, 400) for _ in range(3)]
    lines += [changed(rng, s, rng.randrange(1 + len(s) // 6)) for s in lines] + [s[: -(len(s) // 6) or None] for s in lines]
    rows = [(i, "\n".join(" ".join(s) for s in rng.sample(lines, 3))) for i in range(80)]
    got = {r["rid"]: r["removed"] for r in line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == brute.removed_lines(rows)


def test_verified_whatever_the_batches():
    """Components of one, two and more sets, cut into batches anywhere."""
    rng = random.Random(6)
    rows, want = [], set()
    for c in range(60):
        base = rng.sample(range(1 << 38), 40)
        sets = [set(base[rng.randrange(9) :]) for _ in range(rng.choice((1, 2, 2, 2, 3, 5)))]
        mine = [(c, 1000 * c + i, i, rng.randrange(1000), rng.randrange(9), x) for i, x in enumerate(sets)]
        for a in mine:
            near = [b for b in mine if a is not b and len(a[5] & b[5]) >= 0.8 * len(a[5] | b[5])]
            want |= {(a[1], a[2], *min(b[3:5] for b in near))} if near else set()
        rows += mine
    packed = [b"".join(w.to_bytes(5, "little") for w in sorted(r[5])) for r in rows]
    names, kinds = ["c", "k1", "k2", "rid", "line"], [pa.int64()] * 4 + [pa.int32()]
    table = pa.Table.from_arrays([*(pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)), pa.array(packed, pa.binary())], names=[*names, "words"])
    for most in (1, 2, 3, 7, 1000):
        got = [tuple(r.values()) for b in line_dedup._verified(iter(table.to_batches(most))) for r in b.to_pylist()]
        assert len(got) == len(set(got)) and set(got) == want
