"""Benchmark decontamination: q-gram lemma filter, then banded alignment.

Texts and benchmark items are lower-cased and their white space runs become one space. If an item of m characters occurs
in a text with at most e edits, they share at least m - q + 1 - q * e q-grams, on diagonals (text position minus item
position) that lie within e of each other. So shared q-grams are counted per overlapping band of diagonals; only regions whose
band reaches that count are aligned, in a band around their diagonals.

A text may hold a part of an item only. So an item of more than WINDOW characters goes in whole and as overlapping windows, one
every STEP characters and one at its end, each with its own count and budget. An item counts if it or one of its windows occurs:
any run of WINDOW + STEP - 1 characters of it holds a whole window.

The documents are only filtered or extended: no shuffle and no join. The benchmark goes to the tasks as an index in blocks
of bounded size, one pass of the index lookups per block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.llm.common import fresh, table

Q, RATE = 10, 0.06
WORD = 7  # edits to allow at least, where the lemma can: a word of six letters and a space
WINDOW, STEP = 100, 25
BLOCK_CHARS = 500_000
SLICE = 1 << 19
_M = 0x9E3779B97F4A7C15


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(c: np.ndarray) -> np.ndarray:
    """Hashes of all windows of Q (10) characters, built from windows of 1, 2, 4 and 8."""
    if len(c) < Q:
        return np.zeros(0, np.uint64)
    m = [np.uint64(pow(_M, k, 2**64)) for k in (1, 2, 4)]
    one = (c.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC4CEB9FE1A85EC53)
    two = one[:-1] * m[0] + one[1:]
    four = two[:-2] * m[1] + two[2:]
    eight = four[:-4] * m[2] + four[4:]
    out = eight[:-2] * m[1] + two[8:]
    return (out ^ (out >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)


def budget(m: int, rate: float = RATE) -> int:
    """Edits allowed in m characters: a share of them, or a word if that is more, as far as the lemma leaves a count of 1 or more."""
    return max(0, min(max(int(rate * m), WORD), (m - Q) // Q))


def pieces(c: np.ndarray) -> list[np.ndarray]:
    """The item, then its windows if it is longer than one."""
    if len(c) <= WINDOW:
        return [c]
    return [c, *[c[a : a + WINDOW] for a in [*range(0, len(c) - WINDOW, STEP), len(c) - WINDOW]]]


@dataclass
class Index:
    """The q-grams of a block of items: hashes in order with piece and position, and a table that most other grams miss.

    ``of`` is the item of each piece, ``whole`` whether it is all of it; an item's pieces follow each other, the whole first.
    """

    ids: list
    of: np.ndarray
    whole: np.ndarray
    codes: list[np.ndarray]
    edits: np.ndarray
    need: np.ndarray
    gram: np.ndarray
    item: np.ndarray
    pos: np.ndarray
    shift: np.uint64
    seen: np.ndarray


def build_index(items: list[tuple]) -> Index:
    """Items are (id, text); those shorter than Q characters can't be told from chance and are never reported."""
    items = [(i, codes(normal(t))) for i, t in items]
    items = [(i, c) for i, c in items if len(c) >= Q]
    cut = [pieces(c) for _, c in items]
    of = np.repeat(np.arange(len(items)), [len(x) for x in cut])
    whole = np.ones(len(of), bool)
    whole[1:] = of[1:] != of[:-1]
    cut = [p for x in cut for p in x]
    parts = [grams(c) for c in cut]
    gram = np.concatenate([np.zeros(0, np.uint64), *parts])
    item = np.repeat(np.arange(len(cut)), [len(p) for p in parts])
    pos = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(p)) for p in parts]])
    order = np.argsort(gram, kind="stable")
    bits = min(25, max(16, int(len(gram) * 64).bit_length()))
    seen = np.zeros(1 << bits, bool)
    seen[gram >> np.uint64(64 - bits)] = True
    edits = np.array([budget(len(c)) for c in cut], np.int64)
    need = np.array([len(c) - Q + 1 for c in cut], np.int64) - Q * edits
    return Index([i for i, _ in items], of, whole, cut, edits, need, gram[order], item[order], pos[order], np.uint64(64 - bits), seen)


def align(item: np.ndarray, text: np.ndarray, first: int, width: int, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best occurrence of ``item`` in ``text`` on ``width`` diagonals from ``first``, if within ``most`` edits.

    Each cell holds the edits in its high bits and the start of its path in the low ones, so the minimum keeps both.
    """
    one = np.int64(1) << np.int64(32)
    m = len(item)
    pad = np.full(m + width, 0xFFFFFFFF, np.uint32)
    lo, hi = max(first, 0), min(first + m + width, len(text))
    if hi <= lo:
        return None
    pad[lo - first : hi - first] = text[lo:hi]
    step = np.arange(width, dtype=np.int64) * one
    row = np.arange(width, dtype=np.int64)
    for i in range(m):
        new = row + np.where(pad[i : i + width] == item[i], 0, one)
        new[:-1] = np.minimum(new[:-1], row[1:] + one)
        row = np.minimum.accumulate(new - step) + step
        if not i % 32 and int(row.min() >> 32) > most:
            return None
    best = int(row.argmin())
    edits = int(row[best] >> 32)
    if edits > most:
        return None
    return edits, max(first + int(row[best] & 0xFFFFFFFF), 0), min(first + m + best, len(text))


def find(index: Index, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
    """For each normalised text, (item number, edits, start, end) of the best occurrence of each item it holds.

    That is the best one of the whole item, or if there is none, of a window; a window without edits ends the search.
    """
    out: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
    if not index.ids:
        return out
    c = codes("\0".join(texts))
    begin = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    counted = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    band = index.edits + 1
    most_bands = 2 * int(len(c) + max(map(len, index.codes)) + 4)
    for a in range(0, max(len(c) - Q + 1, 0), SLICE):
        g = grams(c[a : a + SLICE + Q - 1])
        at = np.flatnonzero(index.seen[g >> index.shift])
        left, right = (np.searchsorted(index.gram, g[at], side) for side in ("left", "right"))
        at, left, n = at[right > left], left[right > left], (right - left)[right > left]
        for lo, hi in _runs(n):
            k = n[lo:hi]
            ref = np.repeat(left[lo:hi] - np.concatenate(([0], np.cumsum(k)[:-1])), k) + np.arange(k.sum())
            place = np.repeat(at[lo:hi], k) + a
            text = np.searchsorted(begin, place, "right") - 1
            item = index.item[ref]
            diagonal = place - begin[text] - index.pos[ref]
            which = np.floor_divide(diagonal, band[item])
            also = diagonal - which * band[item] < index.edits[item]
            text, item = np.concatenate((text, text[also])), np.concatenate((item, item[also]))
            which = np.concatenate((which, which[also] - 1))
            key = (text * len(index.codes) + item) * most_bands + which + most_bands // 2
            counted.append(np.unique(key, return_counts=True))
    keys, of = np.unique(np.concatenate([k for k, _ in counted]), return_inverse=True)
    many = np.zeros(len(keys), np.int64)
    np.add.at(many, of, np.concatenate([n for _, n in counted]))
    enough = many >= index.need[keys // most_bands % len(index.codes)]
    best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
    for key in keys[enough].tolist():  # by text, item and piece
        pair, which = divmod(key, most_bands)
        text, piece = divmod(pair, len(index.codes))
        item, part = int(index.of[piece]), int(not index.whole[piece])
        e = int(index.edits[piece])
        so_far = best.get((text, item), (2, 0, 0, 0))
        if part and so_far < (1, 1):  # the whole item, or a window without edits
            continue
        first = (which - most_bands // 2) * int(band[piece]) - e
        found = align(index.codes[piece], c[begin[text] : begin[text + 1] - 1], first, int(band[piece]) + 3 * e + 1, e)
        if found and (part, *found) < so_far:
            best[text, item] = (part, *found)
    for (text, item), found in sorted(best.items()):
        out[text].append((item, *found[1:]))
    return out


def _runs(n: np.ndarray, most: int = 1 << 21):
    """Ranges of hits whose counts add up to about ``most``."""
    if not len(n):
        return
    part = np.cumsum(n) // most
    cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(n)]
    yield from zip(cuts[:-1], cuts[1:], strict=True)


def _id_type(benchmark: DataFrame, item_id: str) -> tuple[T.DataType, pa.DataType]:
    integral = isinstance(benchmark.schema[item_id].dataType, T.IntegralType)
    return (T.LongType(), pa.int64()) if integral else (T.StringType(), pa.string())


def _matcher(index: Index, kind: T.DataType, arrow: pa.DataType, spark):
    shared = spark.sparkContext.broadcast(index)
    row = pa.list_(pa.struct([("item_id", arrow)] + [(n, pa.int32()) for n in ("edits", "start", "end")]))
    result = T.ArrayType(
        T.StructType([T.StructField("item_id", kind)] + [T.StructField(n, T.IntegerType()) for n in ("edits", "start", "end")])
    )

    @F.arrow_udf(result)
    def match(texts: pa.Array) -> pa.Array:
        index, found, run, held = shared.value, [], [], 0

        def flush():
            for hits in find(index, run):
                found.append([{"item_id": index.ids[i], "edits": e, "start": s, "end": t} for i, e, s, t in hits])

        for text in texts:
            run.append(normal(text.as_py()))
            held += len(run[-1])
            if held > SLICE:
                flush()
                run, held = [], 0
        flush()
        return pa.array(found, row)

    return match


def with_matches(docs: DataFrame, benchmark: DataFrame, into: str, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with an array ``into`` (a new name) of the benchmark items that each text holds: item_id, edits, start, end.

    Start and end are places in the normalised text, of the whole item or, if the text only holds a part, of the best window of it. Null and empty texts hold nothing; null items and items shorter than
    10 characters are never found; an item listed twice is found twice; an empty benchmark finds nothing. Repeated rows
    get equal results.
    """
    spark = docs.sparkSession
    kind, arrow = _id_type(benchmark, item_id)
    items = benchmark.where(F.col(item_text).isNotNull()).select(F.col(item_id).cast(kind).alias("i"), F.col(item_text).alias("t"))
    blocks = -(-(items.agg(F.sum(F.length("t"))).first()[0] or 0) // BLOCK_CHARS)
    found = [F.array().cast(T.ArrayType(T.StructType([T.StructField("item_id", kind)] + [T.StructField(n, T.IntegerType()) for n in ("edits", "start", "end")])))]
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == b).collect()
        found.append(_matcher(build_index([(r["i"], r["t"]) for r in part]), kind, arrow, spark)(F.col(text)))
    return docs.withColumn(into, F.concat(*found))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with the columns they came with."""
    (hits,) = fresh(docs, "_hits")
    return with_matches(docs, benchmark, hits).where(F.size(hits) == 0).select(*docs.columns)


def op7_qgram_lemma(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_matches(docs, table(spark, sf_dir, "benchmark"), "hits")
    return found.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")
