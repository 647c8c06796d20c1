"""Importance resampling towards a target corpus: n-gram features in hashed buckets, then a parallel sort by regular sampling.

A document's features are all runs of one to three words; a feature falls into the bucket that the CRC-32 of its bytes names.
Documents and target texts give two histograms of ``BUCKETS`` counts; the logarithm of their ratio is a bucket's gain, and
a document's weight is the sum of gains over its features. Weights are made in arrays: a word's CRC is found once a task,
and the CRC of a run of words follows from those of its words, since appending bytes is linear in the CRC so far.

Gumbel noise from a hash of the id turns the largest scores into a draw without replacement in proportion to the weights.
Scores are ranked by parallel sorting by regular sampling: every run (a task's rows) is sorted and gives each ``step``-th
row; splitters are taken at regular places of the sorted sample; rows are exchanged by segment, each segment is merged in
its task, and the sizes of the segments before it make its local numbers exact ranks. With R runs a segment holds at most about
twice a R-th of the rows, whatever the scores: equal keys are told apart by their run and place. The driver sees two histograms,
and at most ``RUNS`` squared sample keys and ``RUNS`` segment sizes.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import stored, table
from bazaarlake.llm.wordsets import chunks

BUCKETS = 10_000
WIDTH = 3
LEAST_WORDS = 20
SEED = "42"
#: The most runs, hence segments, of the sort. A run is an external sort, so rows / RUNS need not fit in memory.
RUNS = 1000
ROWS_PER_RUN = 1_000_000
LEAST_RUNS = 8
_CACHE = 500_000

#: Bytes of words as they count: A-Z lower-cased; digits, a-z and bytes of longer characters as they are; else a space.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


# -- CRC-32 of runs of words ---------------------------------------------------------------------------------


def _step_table() -> np.ndarray:
    """What a zero byte makes of a CRC's lowest byte."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


_STEP = _step_table()
_NEAR = 256


def _near_tables() -> np.ndarray:
    """[n, k, b]: byte k of a CRC with value b, moved on by n zero bytes."""
    out = np.empty((_NEAR, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, _NEAR):
        out[n] = (out[n - 1] >> 8) ^ _STEP[out[n - 1] & 255]
    return out


_TABLES = _near_tables()
_FLAT = _TABLES.ravel()


def moved(crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    """The part that ``crc`` has in the CRC of its bytes followed by ``by`` others (exclusive or with the CRC of these)."""
    x, left = crc.astype(np.uint32), by.astype(np.int64)
    while True:
        at = np.minimum(left, _NEAR - 1) << 10
        x = (
            _FLAT[at + (x & 255)]
            ^ _FLAT[at + 256 + ((x >> 8) & 255)]
            ^ _FLAT[at + 512 + ((x >> 16) & 255)]
            ^ _FLAT[at + 768 + (x >> 24)]
        )
        left = left - (_NEAR - 1)
        if not (left > 0).any():
            return x
        left = np.maximum(left, 0)


class _Words(dict):
    """CRC (low 32 bits) and length of words seen by this task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE:
            self.clear()
        found = self[word] = zlib.crc32(word) | len(word) << 32
        return found


def feature_buckets(texts: list[bytes], seen: _Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features text by text, how many each text has, and how many words."""
    words, count = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = text.translate(_FOLD).split()
        words += own
        count[i] = len(own)
    packed = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
    crc, size = (packed & np.uint64(0xFFFFFFFF)).astype(np.uint32), (packed >> np.uint64(32)).astype(np.int64)
    spaced = moved(np.full(len(crc), zlib.crc32(b" "), np.uint32), size) ^ crc  # of " word"
    part = np.repeat(np.arange(len(texts)), count)
    values, owners, run = [crc], [part], crc
    for j in range(1, WIDTH):
        run = moved(run[:-1], size[j:] + 1) ^ spaced[j:]
        same = part[j:] == part[: len(part) - j]
        values.append(run[same])
        owners.append(part[j:][same])
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    buckets = (np.concatenate(values)[order] % np.uint32(BUCKETS)).astype(np.int64)
    return buckets, np.bincount(owners, minlength=len(texts)), count


def _pieces(column: pa.Array) -> Iterator[tuple[int, int, list[bytes]]]:
    for a, b, data, offsets in chunks(column):
        raw = data.tobytes()
        yield a, b, [raw[s:e] for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, seen = np.zeros(BUCKETS, np.int64), _Words()
    for batch in batches:
        for _, _, texts in _pieces(batch.column("text")):
            total += np.bincount(feature_buckets(texts, seen)[0], minlength=BUCKETS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["bucket", "n"])


def histogram(texts: DataFrame) -> np.ndarray:
    """Features per bucket over all of ``texts`` (a column ``text``). Tasks send at most ``BUCKETS`` sums each."""
    sums = texts.select("text").mapInArrow(_counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for r in sums.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a weight, in thousandths of a natural logarithm."""
    S, T = int(corpus.sum()), int(target.sum())
    ratio = lambda s, t: float((t + 1) * (S + BUCKETS)) / float((s + 1) * (T + BUCKETS))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)])


def _weigher(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Words()
        for batch in batches:
            for a, b, texts in _pieces(batch.column("text")):
                buckets, n, words = feature_buckets(texts, seen)
                total = np.concatenate(([0], np.cumsum(gain[buckets])))
                ends = np.cumsum(n)
                weight = total[ends] - total[ends - n]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(words), pa.array(n), pa.array(weight)],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    return run


def noise(seed: str = SEED, doc_id: str = "doc_id") -> Column:
    """Standard Gumbel noise in thousandths from a hash of the id; a missing id counts as an empty one."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


# -- ranks by regular sampling --------------------------------------------------------------------------------


RUN_COLUMNS = "doc_id long, n_features long, weight long, score long, run int, place long"
KEY = ("score", "doc_id", "run", "place")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with the number of their run and their place in it."""
    run, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        here = [pa.array(np.full(n, run, np.int32)), pa.array(np.arange(at, at + n))]
        yield pa.RecordBatch.from_arrays([*batch.columns, *here], names=[*batch.schema.names, "run", "place"])
        at += n


def _keys(batch: pa.RecordBatch | pa.Table) -> list[np.ndarray]:
    """The sort key as columns to be ordered upwards: score downwards, missing ids last, run, place."""
    score, doc_id, run, place = (batch.column(k) for k in KEY)
    none = np.asarray(doc_id.is_null())
    return [-np.asarray(score), none, np.asarray(doc_id.fill_null(0)), np.asarray(run).astype(np.int64), np.asarray(place)]


def splitters(sample: pa.Table, runs: int) -> list[np.ndarray]:
    """Keys at regular places of the sorted sample; one less than there are segments."""
    keys = _keys(sample)
    order = np.lexsort(keys[::-1])
    at = order[np.arange(1, runs) * len(order) // runs] if len(order) else order
    return [k[at] for k in keys]


def _segments(split: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = len(split[0])
        for batch in batches:
            both = [np.concatenate((s, k)) for s, k in zip(split, _keys(batch), strict=True)]
            order = np.lexsort(both[::-1])
            is_split = order < m
            before = np.empty(len(order), np.int64)
            before[order] = np.cumsum(is_split)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(before[m:].astype(np.int32))], names=[*batch.schema.names, "segment"]
            )

    return run


def _ranked(first: dict[int, int], drawn: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = dict(first)
        for batch in batches:
            segment = np.asarray(batch.column("segment"))
            rank = np.empty(len(segment), np.int64)
            for s in np.unique(segment).tolist():
                own = np.flatnonzero(segment == s)
                rank[own] = at[s] + 1 + np.arange(len(own))
                at[s] += len(own)
            ranks = pa.array(rank, mask=rank > drawn)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], ranks], names=[*batch.schema.names[:4], "rank"])

    return run


def with_ranks(scored: DataFrame, drawn: int, rows: int) -> DataFrame:
    """``rank`` 1, 2, ... of the ``drawn`` highest scores, ties to the smaller doc_id; null for other rows.

    ``scored`` is a stored table of doc_id, n_features, weight, score with ``rows`` rows. Segments behind the last drawn rank
    are neither exchanged nor merged.
    """
    undrawn = F.lit(None).cast("long").alias("rank")
    if not drawn:
        return scored.withColumn("rank", undrawn)
    wanted = min(RUNS, max(LEAST_RUNS, -(-rows // ROWS_PER_RUN)))
    local = scored.coalesce(wanted).sortWithinPartitions(F.desc("score"), F.asc_nulls_last("doc_id"))
    runs = stored(local.mapInArrow(_runs, RUN_COLUMNS))
    step = max(1, rows // (wanted * wanted))
    split = splitters(runs.where(F.col("place") % step == 0).select(*KEY).toArrow().combine_chunks(), wanted)
    dealt = runs.mapInArrow(_segments(split), f"{RUN_COLUMNS}, segment int")
    sizes = {r["segment"]: r["n"] for r in dealt.groupBy("segment").agg(F.count(F.lit(1)).alias("n")).collect()}
    first, before = {}, 0
    for s in range(wanted):
        first[s] = before
        before += sizes.get(s, 0)
    last = max(s for s in range(wanted) if first[s] < drawn)
    order = [F.asc("segment"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("run"), F.asc("place")]
    merged = (
        dealt.where(F.col("segment") <= last)
        .repartition(wanted, "segment")
        .sortWithinPartitions(*order)
        .mapInArrow(_ranked(first, drawn), "doc_id long, n_features long, weight long, score long, rank long")
    )
    rest = dealt.where(F.col("segment") > last).select("doc_id", "n_features", "weight", "score", undrawn)
    return merged.unionByName(rest)


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    percent: int = 5,
    least_words: int = LEAST_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_features, weight, score, rank.

    Ranked are the documents of at least ``least_words`` words, and of N such the floor(percent * N / 100) highest scores
    are drawn. Null and empty texts have no features and weight 0. Rows repeating a doc_id share their noise and are rows of
    their own; equal keys are ranked in some order, without gaps. A missing id has the noise of an empty one and comes behind
    others of its score. An empty target leaves gains that depend on the corpus alone. Other columns are not looked at; an
    empty table gives no rows.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    gain = gains(histogram(docs), histogram(target.select(F.col(target_text).alias("text"))))
    weighed = docs.mapInArrow(_weigher(gain), "doc_id long, n_words long, n_features long, weight long")
    scored = stored(weighed.withColumn("score", F.col("weight") + noise(seed)))
    able = F.col("n_words") >= least_words
    rows = scored.where(able).count()
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = with_ranks(scored.where(able).select(*columns), percent * rows // 100, rows)
    return ranked.unionByName(scored.where(~able).select(*columns, F.lit(None).cast("long").alias("rank")))


def op13_importance_sort(spark, sf_dir):
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
