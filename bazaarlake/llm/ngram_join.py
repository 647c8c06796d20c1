"""Near-duplicate join on word shingles: an LSH forest of MinHash signatures, then exact verification.

Every distinct shingle set has a signature of ``TREES`` x ``DEPTH`` minima; tree ``t`` files it under a label of
``DEPTH`` minima. Sets that share the first ``d`` minima of a label lie in one node of that tree's prefix trie. Matching
starts with long prefixes, and prefixes are shortened until the expected recall reaches the target for links of every
similarity seen so far: a link of similarity s is found at depth d with probability 1 - (1 - s^d)^TREES, and that must reach
the target in each bin of similarity that holds a link, however many links the others hold. So large groups of near copies
don't settle it for the rest. At the floor depth the target holds even for links exactly at the threshold, whatever the data.

Nothing is done per pair across the cluster. Equal sets are one class from the start, with a number of its own: ids of documents
name results only, since rows may repeat an id with different texts. A node's sets are compared
inside tasks, in blocks of at most ``BLOCK`` sets (a larger node becomes pairs of blocks), and a task returns one row per
set: how many documents it links to, and the smallest class it is connected with. A pair that shares several nodes is counted in the first
tree that has it. Shingle sets are read again only for classes that share a node with another one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import cut, fresh, row_id, small, table
from bazaarlake.llm.components import components
from bazaarlake.llm.wordsets import binaries, chunks, distinct, fixed, groups, mixed, overlaps, set_keys, shingles, word_hashes

WIDTH, THRESHOLD = 5, 0.8
TREES, DEPTH, TARGET = 16, 8, 0.995
BLOCK = 512
BINS = 40

_rng = np.random.default_rng(5)
_XOR = _rng.integers(0, 2**32, TREES * DEPTH, dtype=np.uint32)
_MUL = _rng.integers(0, 2**31, TREES * DEPTH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SALT = mixed(np.arange(1, TREES + 1, dtype=np.uint64))


def signatures(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash signatures (rows: parts). Each hash is a bijection of 32 bits; an empty part gets the largest values."""
    out = np.full((len(bounds) - 1, TREES * DEPTH), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if not len(full):
        return out
    low = (values >> np.uint64(32)).astype(np.uint32)
    x, y = np.empty_like(low), np.empty_like(low)
    for j in range(TREES * DEPTH):
        np.bitwise_xor(low, _XOR[j], out=x)
        np.multiply(x, _MUL[j], out=x)
        np.right_shift(x, np.uint32(15), out=y)
        np.bitwise_xor(x, y, out=x)
        np.multiply(x, np.uint32(0x846CA68B), out=x)
        out[full, j] = np.minimum.reduceat(x, bounds[:-1][full])
    return out


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offsets in chunks(batch.column("text")):
            words, _, bounds = word_hashes(data, offsets)
            values, bounds = shingles(words, bounds, WIDTH)
            sig = signatures(values, bounds)
            values, bounds = distinct(values, bounds)
            k1, k2 = set_keys(values, bounds)
            own = [batch.column(c).slice(a, b - a) for c in ("rid", "th")]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(k1), pa.array(k2), pa.array(np.diff(bounds)), fixed(sig)], names=["rid", "th", "k1", "k2", "n", "sig"]
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offsets in chunks(batch.column("text")):
            words, _, bounds = word_hashes(data, offsets)
            values, bounds = distinct(*shingles(words, bounds, WIDTH))
            k1, k2 = set_keys(values, bounds)
            yield pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2), binaries(values, bounds)], names=["k1", "k2", "members"])


def _node_keys(sig: np.ndarray, depth: int) -> np.ndarray:
    """The keys of each signature's node at ``depth`` in every tree."""
    labels = sig.reshape(len(sig), TREES, DEPTH).astype(np.uint64)
    keys = np.broadcast_to(_SALT, (len(sig), TREES)).copy()
    for j in range(depth):
        keys = mixed(keys * np.uint64(0xD6E8FEB86659FD93) + labels[:, :, j])
    return keys


def _matrix(column, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def _nodes(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = _node_keys(_matrix(batch.column("sig"), np.uint32, TREES * DEPTH), depth)
                cid = np.repeat(np.asarray(batch.column("cid")), TREES)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(cid)], names=["node", "cid"])

    return run


def _with_keys(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = _node_keys(_matrix(batch.column("sig"), np.uint32, TREES * DEPTH), depth)
                yield pa.RecordBatch.from_arrays([batch.column("cid"), batch.column("copies"), fixed(keys)], names=["cid", "copies", "keys"])

    return run


def _owned(group: pa.Table) -> np.ndarray:
    """Which pairs of the group's members this node is to compare: those that share no node of an earlier tree.

    In a pair of different blocks, only pairs across them.
    """
    keys = _matrix(group.column("keys"), np.uint64, TREES)
    node = np.int64(group.column("node")[0].as_py()).view(np.uint64)
    tree = int(np.flatnonzero(keys[0] == node)[0])
    out = np.ones((len(keys), len(keys)), bool)
    for t in range(tree):
        out &= keys[:, t][:, None] != keys[:, t][None, :]
    if group.column("b1")[0].as_py() != group.column("b2")[0].as_py():
        block = np.asarray(group.column("block"))
        out &= block[:, None] != block[None, :]
    np.fill_diagonal(out, False)
    return out


GROUP = ["node", "b1", "b2"]


def _needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members that the node has to compare with another one."""
    for group in groups(batches, GROUP):
        if group.num_rows > 1 and (keep := _owned(group).any(axis=1)).any():
            yield from group.filter(pa.array(keep)).combine_chunks().to_batches()


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per member with a link: the documents it links to, the smallest connected class; with the first row, links by similarity."""
    for group in groups(batches, GROUP):
        sets = [np.frombuffer(x, np.uint64) for x in group.column("members").to_pylist()]
        shared = overlaps(sets)
        size = np.array([len(s) for s in sets])
        union = size[:, None] + size[None, :] - shared
        linked = _owned(group) & (shared >= THRESHOLD * union - 1e-9)
        has = linked.any(axis=1)
        if not has.any():
            continue
        cid = np.asarray(group.column("cid"))
        root = cid.copy()
        while True:
            best = np.minimum(root, np.where(linked, root[None, :], np.iinfo(np.int64).max).min(axis=1))
            if (best == root).all():
                break
            root = best
        s = (shared / np.maximum(union, 1))[np.triu(linked)]
        seen = np.bincount(np.minimum(((s - THRESHOLD) / (1 - THRESHOLD) * BINS).astype(int), BINS - 1).clip(0), minlength=BINS)
        at = np.flatnonzero(has)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(cid[at]),
                pa.array(root[at]),
                pa.array((linked @ np.asarray(group.column("copies")))[at]),
                pa.array([seen.tolist(), *[None] * (len(at) - 1)], pa.list_(pa.int64())),
            ],
            names=["cid", "root", "links", "seen"],
        )


def found_share(similarity: float, depth: int) -> float:
    """Probability that two sets of this similarity share a node at this depth."""
    return 1 - (1 - similarity**depth) ** TREES


def floor_depth(threshold: float = THRESHOLD, target: float = TARGET) -> int:
    return max([1, *[d for d in range(1, DEPTH + 1) if found_share(threshold, d) >= target]])


def next_depth(seen: list[int], depth: int, target: float = TARGET) -> int:
    """The largest depth, up to ``depth``, that reaches the target for each similarity of the links seen; the floor if none is."""
    low = floor_depth(target=target)
    if depth <= low or not any(seen):
        return min(depth, low)
    lowest = THRESHOLD + (1 - THRESHOLD) * next(k for k, n in enumerate(seen) if n) / BINS
    return max((d for d in range(low, depth + 1) if found_share(lowest, d) >= target), default=low)


def _links_at(depth: int, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(cid, root, links, seen) of the links that nodes at ``depth`` show."""
    nodes = classes.select("cid", "sig").mapInArrow(_nodes(depth), "node long, cid long")
    crowded = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = nodes.join(crowded, "node").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    block = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    members = (
        members.withColumn("block", block)
        .withColumn("other", other)
        .select("node", "cid", "block", F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"))
    )
    keyed = classes.select("cid", "copies", "sig").mapInArrow(_with_keys(depth), "cid long, copies long, keys binary")
    schema = "node long, b1 int, b2 int, cid long, block int, copies long, keys binary"
    dealt = members.join(keyed, "cid").select("node", "b1", "b2", "cid", "block", "copies", "keys")
    needed = cut(dealt.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInArrow(_needed, schema))
    wanted = cut(needed.select("cid").distinct().join(classes.select("cid", "k1", "k2", "first"), "cid"))
    ids = small(wanted.select(F.col("first.rid").alias("rid"), F.col("first.th").alias("th")), 1_000_000)  # up to 16 MB
    sets = docs.join(ids, ["rid", "th"], "left_semi").select("text").mapInArrow(_sets, "k1 long, k2 long, members binary")
    sets = sets.dropDuplicates(["k1", "k2"]).join(wanted.select("cid", "k1", "k2"), ["k1", "k2"]).select("cid", "members")
    return cut(
        needed.join(sets, "cid")
        .repartition(*GROUP)
        .sortWithinPartitions(*GROUP)
        .mapInArrow(_verified, "cid long, root long, links long, seen array<long>")
    )


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: rid, th (hash of the text), n_links, first and winner (rid and th of the smallest row with
    an equal set, and of the smallest row of the group), class_key (the group's smallest set key). A row without words is alone, without key."""
    docs = docs.select(row_id(doc_id, text).alias("rid"), F.xxhash64(F.col(text)).alias("th"), F.col(text).alias("text"))
    signed = cut(docs.mapInArrow(_signed, "rid long, th long, k1 long, k2 long, n long, sig binary"))
    row = F.struct("rid", "th")
    counted = signed.where("n > 0").groupBy("k1", "k2").agg(F.min(row).alias("first"), F.count(F.lit(1)).alias("copies"))
    counted = cut(counted.withColumn("cid", F.monotonically_increasing_id()))
    sigs = signed.select("k1", "k2", row.alias("first"), "sig").dropDuplicates(["k1", "k2", "first"])
    classes = cut(counted.join(sigs, ["k1", "k2", "first"]).select("cid", "k1", "k2", "first", "copies", "sig"))
    depth, done = DEPTH, False
    while not done:
        links = _links_at(depth, docs, classes)
        bins = links.where("seen IS NOT NULL").select(F.posexplode("seen").alias("bin", "n")).groupBy("bin").agg(F.sum("n").alias("n"))
        seen = {r["bin"]: r["n"] for r in bins.collect()}
        shorter = next_depth([seen.get(k, 0) for k in range(BINS)], depth)
        depth, done = shorter, shorter == depth
    roots = components(links, "cid", "root").select(F.col("node").alias("cid"), "root")
    linked = links.groupBy("cid").agg(F.sum("links").alias("links"))
    tied = cut(roots.join(counted.select("cid", "k1", "first"), "cid"))  # classes with a link
    groups_ = tied.groupBy("root").agg(F.min("first").alias("winner"), F.min("k1").alias("class_key"))
    of_class = tied.select("cid", "root").join(groups_, "root").join(linked, "cid", "left").drop("root")
    per_class = counted.join(of_class, "cid", "left").select(
        "k1", "k2", "copies", "first", F.coalesce("winner", "first").alias("winner"), F.coalesce("class_key", "k1").alias("class_key"), "links"
    )
    rows = signed.select("rid", "th", "k1", "k2", "n").withColumn("k1", F.when(F.col("n") > 0, F.col("k1")))
    return rows.join(per_class, ["k1", "k2"], "left").select(
        "rid",
        "th",
        (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("first", row).alias("first"),
        F.coalesce("winner", row).alias("winner"),
        "class_key",
    )


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: rid, class_id, n_links, same_set, class_key.

    Two documents are linked if their sets of five-word shingles have a Jaccard similarity of at least 0.8. ``class_id`` is
    the smallest id connected by links; ``n_links`` the number of other rows linked to this one, equal sets included;
    ``same_set`` the smallest id with an equal set. A text of one to four words has its words as only shingle; null and empty
    texts have none and are linked to nothing. ``rid`` is the doc_id, or for a row without one a negative hash of its text. Rows
    repeating a doc_id are rows of their own: two groups that both have it as their smallest share the ``class_id``, and differ in
    ``class_key`` (null without words). An empty table gives no rows; other columns aren't looked at.
    """
    return grouped(docs, doc_id, text).select(
        "rid", F.col("winner.rid").alias("class_id"), "n_links", F.col("first.rid").alias("same_set"), "class_key"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The row of smallest id (then text hash) of each group of near copies, with the columns it came with.

    Of rows that agree in id and text one stays; an id under several texts is as many rows. Rows without words stay. Only rows
    to drop, or to keep once, are joined to the texts, by id and text hash.
    """
    rid, th, role = fresh(docs, "_rid", "_th", "_role")
    found = grouped(docs.select("doc_id", "text")).where("class_key IS NOT NULL")
    found = found.groupBy("rid", "th").agg(F.min("winner").alias("winner"), F.count(F.lit(1)).alias("n"))
    stays = F.struct("rid", "th") == F.col("winner")
    roles = found.where(~stays | (F.col("n") > 1)).select(F.col("rid").alias(rid), F.col("th").alias(th), stays.alias(role))
    marked = docs.withColumn(rid, row_id()).withColumn(th, F.xxhash64("text")).join(small(cut(roles), 1_000_000), [rid, th], "left")
    once = marked.where(F.col(role)).dropDuplicates([rid, th])
    return marked.where(F.col(role).isNull()).unionByName(once).select(*docs.columns)


def op5_lsh_forest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select(F.col("rid").alias("doc_id"), "class_id", "n_links", "same_set", "class_key")
