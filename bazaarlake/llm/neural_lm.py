"""Language-model scores of whole texts: a log-bilinear neural model trained with noise-contrastive estimation.

Tokens are lower-cased words and one end per text. The model's outputs are the ``HEAD`` most frequent tokens and ``CLASSES``
classes of all other words (by their last three bytes); within a class a word has its smoothed share of the class's training
tokens, and each class keeps the share of one unseen word. So every token has a probability, and they add up to one.
Given the two tokens before, the log-bilinear model predicts a vector, the sum of a matrix per position times the vector of the
token there; an output's score is its product with the output's own vector, plus a bias. Training needs no sums over the outputs: each
token is told from ``NOISE`` samples of the output frequencies, shared by a minibatch, so that its gradient is a few matrix products.

At scale: word counts are summed over all training texts. Texts are encoded once to output numbers and stored. A round of training
sends the parameters to all tasks, each passes over its share of the encoded training texts, and the parameters (``rows x DIM`` numbers
a task, whatever the data) are averaged by Spark, weighted by minibatches; ``ROUNDS`` rounds see every training token once, or as
often as makes ``LEAST_TOKENS`` in small corpora. Normalising is a table: all contexts' sums over all outputs, made
once by batched matrix products, a token then costs one product of vectors. Words above one in ``FREQUENT`` of all tokens (fewer than
``FREQUENT`` by arithmetic) go to all tasks with their counts; the rest of a text's words meet their counts by a join on the word, and
none of them is a hot key as far as training texts go. Words are known by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import stored, table
from bazaarlake.llm.wordsets import _SPACE, chunks, mixed, word_hashes

HEAD, CLASSES, DIM = 1024, 512, 32
NOISE, BATCH, ROUNDS = 64, 2048, 3
RATE = 0.15
LEAST_TOKENS = 4_000_000
FREQUENT = 1_000_000
#: The word that stands for the end of a text.
END = 0
_SCALE = 1_000_000
_FLUSH = 2_000_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def is_held_out(doc_id: str = "doc_id") -> Column:
    """The texts that the model does not learn from; a missing id counts as an empty one."""
    return F.crc32(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "UTF-8")) % 5 == 1


# -- words ------------------------------------------------------------------------------------------------------


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and classes of the lower-cased words, and the bounds of each text in words."""
    data = _LOWER[data]
    hashes, start, bounds = word_hashes(data, offsets)
    if not len(hashes):
        return hashes.view(np.int64), np.zeros(0, np.int32), bounds
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    last = np.flatnonzero(word & np.concatenate((~word[1:] | edge[1 : len(data)], [True])))
    code = np.zeros(len(last), np.uint64)
    for j in range(3):
        at = last - j
        code |= np.where(at >= start, data[np.maximum(at, 0)], 0).astype(np.uint64) << np.uint64(8 * j)
    return hashes.view(np.int64), (mixed(code + np.uint64(1)) % np.uint64(CLASSES)).astype(np.int32), bounds


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["word", "class", "n"]
    held: list[tuple[np.ndarray, ...]] = []

    def merged() -> tuple[np.ndarray, ...]:
        word, kind, n = (np.concatenate(x) for x in zip(*held, strict=True))
        word, at, back = np.unique(word, return_index=True, return_inverse=True)
        return word, kind[at], np.bincount(back, weights=n, minlength=len(word)).astype(np.int64)

    size = texts = 0
    for batch in batches:
        texts += batch.num_rows
        for _, _, data, offsets in chunks(batch.column("text")):
            word, kind, _ = words_of(data, offsets)
            word, at, n = np.unique(word, return_index=True, return_counts=True)
            held.append((word, kind[at], n))
            size += len(word)
            if size > _FLUSH:
                held = [merged()]
                size = len(held[0][0])
                if size > _FLUSH // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names=names)
                    held, size = [], 0
    if texts:
        end = (np.array([END], np.int64), np.zeros(1, np.int32), np.array([texts]))
        held.append(end)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged()], names=names)


@dataclass
class Vocabulary:
    """What all tasks need of the word counts. ``word`` is sorted; ``out`` is the output of a head token, -1 for other words."""

    word: np.ndarray
    n: np.ndarray
    out: np.ndarray
    head: int
    end: int
    tokens: int
    types: int
    class_n: np.ndarray
    class_types: np.ndarray

    @property
    def outputs(self) -> int:
        return self.head + CLASSES

    def class_log(self) -> np.ndarray:
        """log10 of what counts in a class are divided by."""
        return np.log10(self.class_n + 0.5 * (self.class_types + 1))

    def frequency(self) -> np.ndarray:
        """Smoothed share of each output among the training tokens."""
        n = np.zeros(self.outputs)
        n[self.out[self.out >= 0]] = self.n[self.out >= 0]
        n[self.head :] = self.class_n
        return (n + 0.5) / (n + 0.5).sum()


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From a stored table (word, class, n). Fewer than ``FREQUENT`` rows, and ``CLASSES`` sums, reach the driver."""
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("types")).first()
    found = counts.where(F.col("n") > F.lit(whole["n"] / FREQUENT)).select("word", "n", "class").toArrow()
    word, n, kind = (np.asarray(found.column(k).combine_chunks()) for k in ("word", "n", "class"))
    order = np.argsort(word)
    word, n, kind = word[order], n[order], kind[order]
    if not (word == END).any():
        at = int(np.searchsorted(word, END))
        word, n, kind = np.insert(word, at, END), np.insert(n, at, 0), np.insert(kind, at, 0)
    rank = np.lexsort((word, -n, word != END))[:HEAD]  # the end of texts, then words by frequency
    out = np.full(len(word), -1, np.int32)
    out[rank] = np.arange(len(rank))
    class_n, class_types = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in counts.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).collect():
        class_n[r["class"]], class_types[r["class"]] = r["n"], r["types"]
    in_head = out >= 0
    class_n -= np.bincount(kind[in_head], weights=n[in_head], minlength=CLASSES)
    class_types -= np.bincount(kind[in_head], weights=n[in_head] > 0, minlength=CLASSES)
    return Vocabulary(word, n, out, len(rank), 0, whole["n"], whole["types"], class_n, class_types)


# -- texts as output numbers ------------------------------------------------------------------------------------

ENCODED = (
    "key long, doc_id long, held_out boolean, n_tokens long, known long, base_log double, word_log double, "
    "ids binary, rare array<long>, times array<int>"
)


def _by_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _sums(values: np.ndarray, part: np.ndarray, parts: int) -> np.ndarray:
    return np.bincount(part, weights=values, minlength=parts)


def _encoder(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = shared.value
        logs, class_log, end = np.log10(v.n + 0.5), v.class_log(), int(np.searchsorted(v.word, END))
        for batch in batches:
            for a, b, data, offsets in chunks(batch.column("text")):
                word, kind, bounds = words_of(data, offsets)
                size, m = np.diff(bounds), b - a
                part = np.repeat(np.arange(m), size)
                at = np.minimum(np.searchsorted(v.word, word), len(v.word) - 1)
                frequent = v.word[at] == word
                out = np.where(frequent, v.out[at], -1)
                tail = out < 0
                out = np.where(tail, v.head + kind, out).astype(np.uint16)
                ids = np.full(len(out) + m, v.out[end], np.uint16)
                ids[np.arange(len(out)) + part] = out
                log = np.where(frequent, logs[at], 0.0)
                base_log = _sums(log, part, m) + logs[end]
                word_log = _sums(np.where(tail, log - class_log[kind], 0.0), part, m)
                known = _sums(frequent.astype(float), part, m).astype(np.int64) + int(v.n[end] > 0)
                left = np.flatnonzero(~frequent)
                order = left[np.lexsort((word[left], part[left]))]
                w, p = word[order], part[order]
                new = np.flatnonzero(np.concatenate(([True], (w[1:] != w[:-1]) | (p[1:] != p[:-1])))) if len(w) else np.zeros(0, np.int64)
                times = np.diff(np.append(new, len(w))).astype(np.int32)
                lists = np.searchsorted(p[new], np.arange(m + 1)).astype(np.int32)
                ends = ((bounds + np.arange(m + 1)) * 2).astype(np.int64)
                binary = pa.Array.from_buffers(pa.large_binary(), m, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(ids))]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).slice(a, m) for c in ("key", "doc_id", "held_out")],
                        pa.array(size + 1),
                        pa.array(known),
                        pa.array(base_log),
                        pa.array(word_log),
                        binary,
                        pa.ListArray.from_arrays(pa.array(lists), pa.array(w[new])),
                        pa.ListArray.from_arrays(pa.array(lists), pa.array(times)),
                    ],
                    names=["key", "doc_id", "held_out", "n_tokens", "known", "base_log", "word_log", "ids", "rare", "times"],
                )

    return run


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All output numbers of a column of binaries, and the bounds of each."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    ids = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(np.uint16) if len(column) else np.zeros(0, np.uint16)
    return ids, (offsets - offsets[0]) // 2


def contexts(ids: np.ndarray, bounds: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens one and two places before each, ``begin`` where the text has none."""
    one = np.concatenate(([begin], ids[:-1])).astype(np.int64)
    two = np.concatenate(([begin, begin], ids[:-2])).astype(np.int64)[: len(ids)]
    starts = bounds[:-1][np.diff(bounds) > 0]
    one[starts] = begin
    two[starts] = begin
    second = starts[starts + 1 < len(ids)] + 1
    two[second] = begin  # the next text's first token, if this text has one token only, is begin already
    return one, two


# -- the model --------------------------------------------------------------------------------------------------


class Model:
    """Vectors of context tokens (``near``) and outputs (``far``), a matrix per position, a bias per output."""

    def __init__(self, outputs: int):
        self.outputs = outputs
        bias_rows = -(-outputs // DIM)
        self.rows = np.zeros((outputs + 1 + outputs + 2 * DIM + bias_rows, DIM), np.float32)
        self.near = self.rows[: outputs + 1]
        self.far = self.rows[outputs + 1 : 2 * outputs + 1]
        self.turn = [self.rows[2 * outputs + 1 + j * DIM :][:DIM] for j in range(2)]
        self.bias = self.rows[2 * outputs + 1 + 2 * DIM :].reshape(-1)

    @classmethod
    def fresh(cls, frequency: np.ndarray) -> Model:
        """Small random vectors, and the log frequency as bias: the model starts as the frequencies themselves."""
        model, rng = cls(len(frequency)), np.random.default_rng(11)
        model.near[:] = rng.normal(0, 0.3, model.near.shape)
        model.far[:] = rng.normal(0, 0.03, model.far.shape)
        for turn in model.turn:
            turn[:] = np.eye(DIM) + rng.normal(0, 0.05, turn.shape)
        model.bias[: len(frequency)] = np.log(frequency)
        return model

    @classmethod
    def of(cls, outputs: int, rows: np.ndarray) -> Model:
        model = cls(outputs)
        model.rows[:] = rows
        return model

    def moved(self) -> tuple[np.ndarray, np.ndarray]:
        """What each context token adds to the predicted vector from one and two places before."""
        return self.near @ self.turn[0].T, self.near @ self.turn[1].T

    def normalisers(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Log sums over all outputs for contexts given by their vectors."""
        scores = (one + two) @ self.far.T
        scores += self.bias[: self.outputs]
        top = scores.max(axis=1, keepdims=True)
        scores -= top
        np.exp(scores, out=scores)
        return np.log(scores.sum(axis=1)) + top[:, 0]


def _gather_sums(rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``rows`` with equal ``at``, and these."""
    order = np.argsort(at.astype(np.uint16), kind="stable")
    at = at[order]
    new = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return np.add.reduceat(rows[order], new, axis=0), at[new]


class Trainer:
    """Noise-contrastive estimation with AdaGrad steps on one task's minibatches."""

    def __init__(self, model: Model, frequency: np.ndarray, seed: tuple[int, ...], rate: float):
        self.model, self.rate = model, np.float32(rate)
        self.rng = np.random.default_rng(seed)
        self.cumulated = np.cumsum(frequency)
        self.offset = np.log(NOISE * frequency).astype(np.float32)
        self.squares = Model(model.outputs)
        self.squares.rows[:] = 0.1
        self.steps = 0

    def _step(self, rows: np.ndarray, squares: np.ndarray, gradient: np.ndarray, at=slice(None)) -> None:
        squares[at] += gradient * gradient
        rows[at] -= self.rate * gradient / np.sqrt(squares[at])

    def minibatch(self, ids: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        m, s = self.model, self.squares
        noise = np.searchsorted(self.cumulated, self.rng.random(NOISE) * self.cumulated[-1]).clip(max=m.outputs - 1)
        near = m.near[one], m.near[two]
        predicted = near[0] @ m.turn[0].T + near[1] @ m.turn[1].T
        target, others = m.far[ids], m.far[noise]
        right = np.einsum("ij,ij->i", predicted, target) + m.bias[ids] - self.offset[ids]
        wrong = predicted @ others.T + (m.bias[noise] - self.offset[noise])
        scale = np.float32(1 / len(ids) ** 0.5)
        right = (1 / (1 + np.exp(-right.clip(-30, 30))) - 1) * scale
        wrong = 1 / (1 + np.exp(-wrong.clip(-30, 30))) * scale
        back = right[:, None] * target + wrong @ others
        far, far_at = _gather_sums(np.concatenate((right[:, None] * predicted, wrong.T @ predicted)), np.concatenate((ids, noise)))
        bias, bias_at = _gather_sums(np.concatenate((right, wrong.sum(axis=0)))[:, None], np.concatenate((ids, noise)))
        turns = [back.T @ near[j] for j in range(2)]
        both, near_at = _gather_sums(np.concatenate((back @ m.turn[0], back @ m.turn[1])), np.concatenate((one, two)))
        self._step(m.far, s.far, far, far_at)
        self._step(m.bias, s.bias, bias[:, 0], bias_at)
        self._step(m.near, s.near, both, near_at)
        for j in range(2):
            self._step(m.turn[j], s.turn[j], turns[j])
        self.steps += 1

    def text(self, ids: np.ndarray, bounds: np.ndarray) -> None:
        one, two = contexts(ids, bounds, self.model.outputs)
        ids = ids.astype(np.int64)
        for a in range(0, len(ids), BATCH):
            self.minibatch(ids[a : a + BATCH], one[a : a + BATCH], two[a : a + BATCH])


def _learner(shared, turn: int, times: int, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, frequency = shared.value
        trainer = None
        for batch in batches:
            if trainer is None:
                trainer = Trainer(Model.of(len(frequency), rows), frequency, (turn, TaskContext.get().partitionId()), rate)
            for _ in range(times):
                trainer.text(*_ids(batch.column("ids")))
        if trainer is not None and trainer.steps:
            learned = np.rint(trainer.model.rows.astype(np.float64) * _SCALE).astype(np.int64) * trainer.steps
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(learned), dtype=np.int32)),
                    pa.array(np.full(len(learned), trainer.steps, np.int64)),
                    pa.FixedSizeListArray.from_arrays(pa.array(learned.ravel()), DIM).cast(pa.list_(pa.int64())),
                ],
                names=["row", "steps", "v"],
            )

    return run


def train(encoded: DataFrame, frequency: np.ndarray, tokens: int) -> Model:
    """The model after ``ROUNDS`` rounds over the stored training texts (column ``ids``).

    Sums are of whole numbers, so reruns on the same stored table agree. The driver receives one averaged row per row of parameters.
    """
    spark = encoded.sparkSession
    model = Model.fresh(frequency)
    times = max(1, min(16, -(-LEAST_TOKENS // max(tokens, 1))))
    share = F.pmod(F.xxhash64("key"), F.lit(ROUNDS))
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast((model.rows, frequency))
        learned = encoded.where(share == turn).select("ids").mapInArrow(
            _learner(shared, turn, times, RATE / (1 + turn) ** 0.5), "row int, steps long, v array<long>"
        )
        sums = learned.groupBy("row").agg(F.sum("steps").alias("steps"), *[F.sum(F.col("v")[d]).alias(f"v{d}") for d in range(DIM)])
        found = sums.toArrow()
        if found.num_rows:
            rows = np.asarray(found.column("row"))
            steps = np.asarray(found.column("steps")).astype(np.float64)
            for d in range(DIM):
                model.rows[rows, d] = np.asarray(found.column(f"v{d}")) / steps / _SCALE
        shared.unpersist()
    return model


def normaliser_table(spark, model: Model, tasks: int = 96) -> np.ndarray:
    """[one, two]: the log sum over all outputs in each context. Its size depends on the number of outputs only."""
    size = model.outputs + 1
    shared = spark.sparkContext.broadcast((model.outputs, model.rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.of(*shared.value)
        one, two = own.moved()
        for batch in batches:
            for i in batch.column("id").to_pylist():
                found = own.normalisers(one[i][None, :], two).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([found.tobytes()], pa.binary())], names=["one", "logs"])

    out = np.empty((size, size), np.float32)
    found = spark.range(0, size, 1, min(tasks, size)).mapInArrow(run, "one long, logs binary").toArrow()
    for one, row in zip(found.column("one").to_pylist(), found.column("logs"), strict=True):
        out[one] = np.frombuffer(row.as_buffer(), np.float32)
    shared.unpersist()
    return out


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        outputs, rows, logs = shared.value
        model = Model.of(outputs, rows)
        first, second = model.moved()
        for batch in batches:
            ids, bounds = _ids(batch.column("ids"))
            one, two = contexts(ids, bounds, outputs)
            ids, found = ids.astype(np.int64), np.empty(len(ids))
            for a in range(0, len(ids), 1 << 16):
                w, x, y = ids[a : a + (1 << 16)], one[a : a + (1 << 16)], two[a : a + (1 << 16)]
                found[a : a + (1 << 16)] = np.einsum("ij,ij->i", first[x] + second[y], model.far[w]) + model.bias[w] - logs[x, y]
            part = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            model_log = _sums(found, part, len(bounds) - 1) / math.log(10)
            kept = [batch.column(c) for c in SCORED[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(model_log)], names=list(SCORED))

    return run


SCORED = ("key", "doc_id", "held_out", "n_tokens", "known", "base_log", "word_log", "model_log")


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Texts with crc32(doc_id) mod 5 = 1 are held out of counts and training. Scores are log10 probabilities of whole texts;
    ``base_score`` is that of smoothed word frequencies. A null text counts as an empty one, which is an end only; rows
    repeating an id are rows of their own, and count as often as they come; a missing id counts as an empty one. Without training
    texts all words are unknown and the model is uniform noise around equal frequencies. Other columns are not looked at; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), is_held_out(doc_id).alias("held_out"), F.col(text).alias("text"))
    learned = docs.where("NOT held_out").select("text").mapInArrow(_count, "word long, class int, n long")
    counts = stored(learned.groupBy("word").agg(F.min("class").alias("class"), F.sum("n").alias("n")))
    v = vocabulary(counts)
    shared = spark.sparkContext.broadcast(v)
    keyed = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", "held_out", "text")
    encoded = stored(keyed.mapInArrow(_encoder(shared), ENCODED))
    shared.unpersist()

    frequency = v.frequency()
    model = train(encoded.where("NOT held_out").select("key", "ids"), frequency, v.tokens)
    logs = spark.sparkContext.broadcast((model.outputs, model.rows, normaliser_table(spark, model)))
    fields = "key long, doc_id long, held_out boolean, n_tokens long, known long, base_log double, word_log double, model_log double"
    scored = encoded.select(*SCORED[:-1], "ids").mapInArrow(_scorer(logs), fields)

    pairs = encoded.select("key", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("key", F.col("w.rare").alias("word"), F.col("w.times").alias("times"))
    met = pairs.join(counts.where(F.col("n") <= F.lit(v.tokens / FREQUENT)).select("word", "n"), "word", "left")
    rare = met.groupBy(F.col("key").alias("of")).agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_log"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
    )
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return scored.join(rare, F.col("key") == F.col("of"), "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("base_log") + rare_log - F.col("n_tokens") * F.lit(math.log10(v.tokens + 0.5 * (v.types + 1)))).alias("base_score"),
        (F.col("model_log") + F.col("word_log") + rare_log).alias("score"),
    )


def op11_log_bilinear(spark, sf_dir):
    return score(table(spark, sf_dir, "documents"))
