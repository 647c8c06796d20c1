"""The whole pipeline on awkward rows: repeated ids with different texts, rows alike, no ids, no texts, an empty corpus."""

from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bazaarlake.llm import quality_rules
from bazaarlake.session import work_dir

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark):
    good = [r["text"] for r in quality_rules.keep(spark.read.parquet(f"{SF}/documents.parquet")).orderBy("doc_id").collect()]
    good = list(dict.fromkeys(good))[:60]
    rows = [(i, t) for i, t in enumerate(good[:30])]
    rows += [(5, t) for t in good[30:36]]  # one id, unrelated texts
    rows += [(7, good[40]), (8, good[40] + " once more"), (9, good[41]), (9, good[40])]  # copies under other ids
    rows += [(None, good[42]), (None, good[42]), (None, good[43]), (None, None), (50, None), (51, ""), (52, "too short")]
    rows += [(60, good[44])] * 25 + [(61, good[45])]
    path = work_dir(spark, "awkward")
    data = [(i, t, "en", f"s{k % 3}" if k % 5 else None, len(t or "")) for k, (i, t) in enumerate(rows)]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(5).write.parquet(f"{path}/documents.parquet")
    bench = [(1, good[45][200:420]), (2, None), (3, "")]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, good


def test_no_text_is_lost_and_none_is_kept_twice(spark, folder):
    path, rows, good = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:2]:
        kept = stage(spark, kept, path)
        assert kept.columns == docs.columns, name
    texts = [r["text"] for r in kept.collect()]
    found = brute.near_duplicates(list(enumerate(dict.fromkeys(t for _, t in rows if t in set(good) or t and "once more" in t))))
    group = dict(zip(dict.fromkeys(t for _, t in rows if t in set(good) or t and "once more" in t), (g for g, _ in found.values()), strict=True))
    assert len(texts) == len({group[t] for t in texts}) == len(set(group.values()))


def test_the_whole_run(spark, folder):
    path, rows, good = folder
    out = corpus_pipeline.run(spark, path).collect()
    given = Counter(rows)
    taken = Counter((r["doc_id"], r["text"]) for r in out)
    assert out and all(n <= 2 for n in taken.values()) and set(taken) <= set(given)
    assert not any(r["text"] in (good[45], None, "", "too short") for r in out)
    at = defaultdict(list)
    for r in out:
        at[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in at.values())


def test_an_empty_corpus(spark, folder):
    path, _, _ = folder
    empty = work_dir(spark, "empty")
    for table in ("documents", "benchmark"):
        spark.read.parquet(f"{path}/{table}.parquet").where("false").write.parquet(f"{empty}/{table}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
    spark.read.parquet(f"{path}/documents.parquet").withColumn("text", F.lit(None).cast("string")).write.parquet(f"{empty}-null/documents.parquet")
    spark.read.parquet(f"{path}/benchmark.parquet").write.parquet(f"{empty}-null/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{empty}-null").count() == 0
