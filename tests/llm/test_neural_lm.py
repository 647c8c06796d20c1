"""The log-bilinear model: base scores against a plain version, probabilities that add up, held-out texts better than by frequency."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from bazaarlake.llm import neural_lm

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall


def tokens(text):
    return WORDS("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) + [None]


def plain(rows):
    """[(doc_id, held_out, n_tokens, n_known, train_tokens, base_score)]"""
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    c = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    n, v = sum(c.values()), len(c)
    out = []
    for i, text in rows:
        own = tokens(text)
        base = sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        out.append((i, held(i), len(own), sum(t in c for t in own), n, base))
    return out


def compare(df, rows):
    got = df.collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")
    for a, b in zip(sorted((tuple(r[n] for n in names) for r in got), key=key), sorted(plain(rows), key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    return got


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(neural_lm, "HEAD", 50)
    monkeypatch.setattr(neural_lm, "LEAST_TOKENS", 200_000)


def test_registered_table(spark, small, monkeypatch):
    monkeypatch.setattr(neural_lm, "FREQUENT", 2000)  # so that most words are met by the join
    kept = {}
    monkeypatch.setattr(neural_lm, "train", lambda *a, f=neural_lm.train: kept.setdefault("model", f(*a)))
    monkeypatch.setattr(neural_lm, "vocabulary", lambda c, f=neural_lm.vocabulary: kept.setdefault("v", f(c)))
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = compare(neural_lm.op11_log_bilinear(spark, SF), rows)

    # The scores again, one token at a time.
    model, v = kept["model"], kept["v"]
    hashed = lambda w: neural_lm.words_of(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w.encode())]))
    held = {r["doc_id"]: r["held_out"] for r in got}
    counts = Counter(t for i, text in rows if not held[i] for t in tokens(text))
    head = dict(zip(v.word[v.out >= 0].tolist(), v.out[v.out >= 0].tolist(), strict=True))

    def output(t):
        if t is None:
            return head[neural_lm.END], 0.0
        word, kind, _ = hashed(t)
        if int(word[0]) in head:
            return head[int(word[0])], 0.0
        k = int(kind[0])
        return v.head + k, math.log10((counts[t] + 0.5) / (v.class_n[k] + 0.5 * (v.class_types[k] + 1)))

    for r in got[:40]:
        text = dict(rows)[r["doc_id"]]
        one = two = model.outputs
        total = 0.0
        for t in tokens(text):
            out, inside = output(t)
            vector = model.turn[0] @ model.near[one] + model.turn[1] @ model.near[two]
            scores = (model.far @ vector + model.bias[: model.outputs]).astype(np.float64)
            total += (scores[out] - np.log(np.exp(scores).sum())) / math.log(10) + inside
            one, two = out, one
        assert r["score"] == pytest.approx(total, rel=1e-4, abs=1e-3)

    # In each class the known words and one unknown share all there is.
    kinds = Counter()
    for t, n in counts.items():
        if t is not None and int(hashed(t)[0][0]) not in head:
            kinds[int(hashed(t)[1][0])] += n + 0.5
    for k in range(neural_lm.CLASSES):
        assert kinds[k] + 0.5 == pytest.approx(v.class_n[k] + 0.5 * (v.class_types[k] + 1))


def test_odd_rows(spark, small):
    rows = [(i, f"The cat {i % 7} sat. On the mat") for i in range(60)]
    rows += [(None, None), (None, "the Cat"), (3, ""), (3, " \n"), (7, "ÄÖ the"), (8, "word " * 30_000), (9, "x" * 70_000), (9, "the.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS key", "'a' AS rare", "2 AS n").repartition(3)
    compare(neural_lm.score(docs), rows)
    assert neural_lm.score(docs.where("false")).count() == 0
    held = [(i, "a b") for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1]
    compare(neural_lm.score(spark.createDataFrame(held, "doc_id long, text string")), held)


def test_contexts():
    ids, bounds = np.array([5, 6, 7, 8, 9, 1]), np.array([0, 3, 3, 4, 6])
    one, two = neural_lm.contexts(ids, bounds, 99)
    assert one.tolist() == [99, 5, 6, 99, 99, 9]
    assert two.tolist() == [99, 99, 5, 99, 99, 99]


def test_normalisers_are_exact():
    rng = np.random.default_rng(1)
    model = neural_lm.Model.fresh(rng.dirichlet(np.ones(40)))
    model.rows[:] += rng.normal(0, 0.3, model.rows.shape)
    one, two = model.moved()
    logs = model.normalisers(one[:5], two[:5])
    for i in range(5):
        assert logs[i] == pytest.approx(math.log(np.exp((one[i] + two[i]) @ model.far.T + model.bias[:40]).sum()), rel=1e-5)


def test_held_out_texts_score_better_than_by_frequency(spark, monkeypatch):
    monkeypatch.setattr(neural_lm, "HEAD", 256)
    monkeypatch.setattr(neural_lm, "LEAST_TOKENS", 1_500_000)
    got = neural_lm.op11_log_bilinear(spark, "/root/testdata/sf0.01").where("held_out").agg(
        {"score": "sum", "base_score": "sum", "n_tokens": "sum"}
    ).first()
    assert got["sum(score)"] > got["sum(base_score)"] + 0.02 * got["sum(n_tokens)"]
