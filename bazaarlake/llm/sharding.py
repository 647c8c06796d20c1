"""Sharding by fixed virtual slots.

Records are hashed into a fixed number of slots that never changes. Bytes and rows are summed per slot, and a small
versioned table maps slots to shards. Balancing, adding or removing shards only edits that map: a new version is
written, old ones stay readable, and records move only with their slot. The map has ``SLOTS`` rows whatever the
data's size; it is the only thing that passes the driver.

A record's slot follows from its id; one without an id goes by its text. An id, or such a text, of more than ``PIECE`` rows is
spread: its rows go by id, text and the number of ``PIECE`` rows alike, so that no slot has more than ``PIECE`` of one kind.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.llm.common import clear_names, cut, fresh, occurrences, small, table
from bazaarlake.operators.series import number_within
from bazaarlake.session import work_dir

SLOTS = 8192
PIECE = 64
ROWS = 1_000_000
MAP_SCHEMA = T.StructType(
    [
        T.StructField("vslot", T.IntegerType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("first", T.LongType()),
    ]
)


def _identity(doc_id: str, text: str) -> Column:
    return F.when(F.col(doc_id).isNull(), F.xxhash64(F.col(text))).otherwise(F.xxhash64(F.col(doc_id).cast("string")))


def slotted(docs: DataFrame, name: str, doc_id: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """``docs`` with the slot of each record in a column ``name``.

    Identities are counted in one narrow shuffle. Rows of those with more than ``PIECE`` rows are numbered among rows alike in
    id and text; others stay put. Which of two rows alike has which slot is open, how many go to each is not.
    """
    own, th, place = fresh(docs, "_identity", "_text_hash", "_place")
    keyed = docs.withColumn(own, _identity(doc_id, text))
    hot = keyed.groupBy(own).agg(F.count(F.lit(1)).alias(th)).where(F.col(th) > PIECE).drop(th)
    hot = cut(hot)
    if hot.isEmpty():
        return keyed.withColumn(name, F.pmod(own, F.lit(slots)).cast("int")).drop(own)
    hot = small(hot, 1_000_000)
    cold = keyed.join(hot, own, "left_anti").withColumn(name, F.pmod(own, F.lit(slots)).cast("int"))
    spread = occurrences(keyed.join(hot, own, "left_semi").withColumn(th, F.xxhash64(F.col(text))), [own, th], place)
    piece = F.xxhash64(own, th, F.floor((F.col(place) - 1) / PIECE).cast("long"))
    spread = spread.withColumn(name, F.pmod(piece, F.lit(slots)).cast("int"))
    return cold.select(*docs.columns, name).unionByName(spread.select(*docs.columns, name))


def record_bytes(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 16).cast("long")


def slot_loads(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", slots: int = SLOTS, size: Column | None = None
) -> dict[int, tuple[int, int]]:
    """Bytes and rows of each slot that has records; at most ``slots`` rows reach the driver."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), (record_bytes(text) if size is None else size).alias("size"))
    found = (
        slotted(slim, "vslot", slots=slots)
        .select("vslot", "size")
        .groupBy("vslot")
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    )
    return {r["vslot"]: (r["bytes"], r["rows"]) for r in found.collect()}


def rebalanced(placed: dict[int, int], loads: dict[int, tuple[int, int]], shards: int) -> dict[int, int]:
    """An edited map on ``shards`` shards with near-equal bytes that leaves slots in place where it can.

    Each shard keeps its slots, largest first, as long as they fit the mean. The others, and those of shards that no
    longer exist, go to the lightest shard, largest first. Then slots are moved or swapped between the heaviest and the
    lightest shard while that brings the two closer. Ties go to the lower number, so reruns agree.
    """
    size = lambda s: loads.get(s, (0, 0))[0]
    mean = sum(b for b, _ in loads.values()) / shards
    held: list[list[int]] = [[] for _ in range(shards)]
    total = [0] * shards
    loose = []
    for s in sorted(placed, key=lambda s: (-size(s), s)):
        shard = placed[s]
        if shard < shards and total[shard] + size(s) <= mean:
            held[shard].append(s)
            total[shard] += size(s)
        else:
            loose.append(s)
    heap = [(t, i) for i, t in enumerate(total)]
    heapq.heapify(heap)
    for s in loose:
        t, i = heapq.heappop(heap)
        held[i].append(s)
        total[i] += size(s)
        heapq.heappush(heap, (total[i], i))
    for _ in range(20 * shards):
        high = max(range(shards), key=lambda i: (total[i], -i))
        low = min(range(shards), key=lambda i: (total[i], i))
        gap = total[high] - total[low]
        give = sorted((size(s), s) for s in held[high])
        take = [(0, -1), *sorted((size(s), s) for s in held[low])]
        best, k = (gap, 0, 0, 0), 0
        for a, s in give:
            while k + 1 < len(take) and abs(gap - 2 * (a - take[k + 1][0])) <= abs(gap - 2 * (a - take[k][0])):
                k += 1
            best = min(best, (abs(gap - 2 * (a - take[k][0])), s, take[k][1], a - take[k][0]))
        if best[0] >= gap or best[3] <= 0:
            break
        _, s, back, moved = best
        held[high].remove(s)
        held[low].append(s)
        if back >= 0:
            held[low].remove(back)
            held[high].append(back)
        total[high] -= moved
        total[low] += moved
    return {s: i for i, own in enumerate(held) for s in own}


@dataclass
class SlotMap:
    """The stored versions of one slot-to-shard map, as ``<path>/version=<n>``."""

    spark: SparkSession
    path: str

    def write(self, version: int, placed: dict[int, int], loads: dict[int, tuple[int, int]]) -> DataFrame:
        """Stores a version. ``first`` is the number of the slot's first record within its shard."""
        rows, nxt = [], {}
        for s in sorted(placed):
            b, n = loads.get(s, (0, 0))
            rows.append((s, placed[s], b, n, nxt.get(placed[s], 0)))
            nxt[placed[s]] = nxt.get(placed[s], 0) + n
        self.spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/version={version}")
        return self.read(version)

    def read(self, version: int) -> DataFrame:
        return self.spark.read.schema(MAP_SCHEMA).parquet(f"{self.path}/version={version}")

    def placed(self, version: int) -> dict[int, int]:
        return {r["vslot"]: r["shard"] for r in self.read(version).collect()}


def balanced_map(
    docs: DataFrame, shards: int, path: str, doc_id: str = "doc_id", text: str = "text", size: Column | None = None
) -> DataFrame:
    """Version 1 deals the slots out in turn; version 2 is that map edited by the bytes found. Returns version 2."""
    store = SlotMap(docs.sparkSession, path)
    loads = slot_loads(docs, doc_id, text, size=size)
    store.write(1, {s: s % shards for s in range(SLOTS)}, loads)
    return store.write(2, rebalanced(store.placed(1), loads, shards), loads)


def assign(docs: DataFrame, slot_map: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with vslot, shard and slot (the record's number within its shard, without gaps from 0).

    Null texts count 16 bytes; rows repeating an id are numbered apart, and share its slot up to ``PIECE`` of them; columns of
    ``docs`` named like an added one are kept as ``in_<name>``. The map (``SLOTS`` rows) is broadcast. Numbers come from the
    slot's first number plus a count within the slot, made in as many pieces as keep a piece to about ``ROWS`` rows.
    """
    docs = clear_names(docs, ("vslot", "shard", "slot"))
    vslot, shard, first, n, size, by = fresh(docs, "vslot", "shard", "_first", "_n", "_size", "_by")
    most = slot_map.agg(F.coalesce(F.max("rows"), F.lit(0)).alias("n")).first()["n"]
    pieces = max(1, -(-most // ROWS))
    order = [F.col(doc_id).asc_nulls_last(), F.xxhash64(F.col(text))]
    records = slotted(docs, vslot, doc_id, text)
    if pieces == 1:
        numbered = records.withColumn(n, F.row_number().over(Window.partitionBy(vslot).orderBy(*order)).cast("long"))
    else:
        of = F.xxhash64(F.lit("piece"), _identity(doc_id, text), F.xxhash64(F.col(text)))
        records = records.withColumn(by, F.pmod(of, F.lit(pieces)))
        numbered = number_within(records, [vslot], F.col(by), order, n, size).drop(by, size)
    joined = numbered.join(F.broadcast(slot_map.select(F.col("vslot").alias(vslot), F.col("shard").alias(shard), F.col("first").alias(first))), vslot)
    return joined.select(*docs.columns, vslot, shard, (F.col(first) + F.col(n) - 1).alias("slot"))


def op3_virtual_slots(spark, sf_dir, shards: int = 40):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    slim = docs.select(  # a hash stands for the text: the result needs no more of it
        "doc_id",
        record_bytes().alias("size"),
        F.crc32(F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))).alias("text_crc32"),
        F.when(F.col("text").isNotNull(), F.xxhash64("text").cast("string")).alias("text"),
    )
    slim = cut(slim)
    placed = balanced_map(slim, shards, work_dir(spark, "slot-map"), size=F.col("size"))
    return assign(slim, placed).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "vslot",
    )
