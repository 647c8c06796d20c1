"""Importance resampling against a plain version: features, weights, noise and exact ranks."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from bazaarlake.llm import importance

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall


def plain(docs, target, least=20, percent=5):
    """[(doc_id, n_features, weight, score, rank)] in order of rank, undrawn rows last."""

    def features(text):
        w = WORDS("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        return len(w), [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    S, T = [0] * 10000, [0] * 10000
    for side, texts in ((S, [t for _, t in docs]), (T, target)):
        for text in texts:
            for f in features(text)[1]:
                side[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t + 1) * (sum(S) + 10000) / ((s + 1) * (sum(T) + 10000)))) for s, t in zip(S, T, strict=True)]
    rows = []
    for i, text in docs:
        words, found = features(text)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((words >= least, (i, len(found), weight, score)))
    able = sorted((r for ok, r in rows if ok), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    n = percent * len(able) // 100
    return [(*r, k + 1 if k < n else None) for k, r in enumerate(able)] + [(*r, None) for ok, r in rows if not ok]


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_crc_of_runs():
    rng = random.Random(1)
    for length in (0, 1, 5, 254, 255, 256, 257, 511, 1000, 70_000):
        a, b = rng.randbytes(7), rng.randbytes(length)
        crc = importance.moved(np.array([zlib.crc32(a)]), np.array([length]))
        assert int(crc[0]) ^ zlib.crc32(b) == zlib.crc32(a + b)


@pytest.mark.parametrize("rows_per_run", [1_000_000, 40])
def test_registered_table(spark, rows_per_run, monkeypatch):
    monkeypatch.setattr(importance, "ROWS_PER_RUN", rows_per_run)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = plain([(r["doc_id"], r["text"]) for r in docs], target)
    assert result(importance.op13_importance_sort(spark, SF)) == sorted(want, key=str)


def test_odd_rows(spark):
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choice("Ab cé d7 ee,ff Ünd x".split(" ")) for _ in range(n))
    rows = [(i, text(rng.randrange(15, 60))) for i in range(400)]
    rows += [(None, None), (None, ""), (500, "9" * 3000 + " b " * 30), (None, text(40)), (501, "-- !"), (502, text(30_000))]
    rows += [(7, rows[7][1])] * 300  # one row very often
    target = [text(50), None, "", "cé D7"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS rank", "'x' AS score", "2 AS run").repartition(6)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(docs, goal, percent=45)
    want = plain(rows, target, percent=45)
    assert result(got) == sorted(want, key=str)
    ranks = sorted(r[4] for r in result(got) if r[4])
    assert ranks == list(range(1, len(ranks) + 1))
    assert importance.resample(docs.where("false"), goal).count() == 0
    assert {r["rank"] for r in importance.resample(docs.limit(3), goal.where("false")).collect()} == {None}


def test_segments_are_even_on_ties(spark, monkeypatch):
    """All rows share one key; regular sampling still deals them out evenly."""
    monkeypatch.setattr(importance, "ROWS_PER_RUN", 500)
    rows = spark.range(0, 8000, 1, 10).selectExpr("5L AS doc_id", "1L AS n_features", "2L AS weight", "3L AS score")
    ranked = importance.with_ranks(rows, 8000, 8000)
    per_task = ranked.selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()
    assert sorted(r["rank"] for r in ranked.select("rank").collect()) == list(range(1, 8001))
    assert max(r["count"] for r in per_task) < 3 * 8000 / 16 + 600
