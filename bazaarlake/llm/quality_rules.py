"""Quality rules kept as a ledger of failure bits.

Every rule is evaluated once per document: the ledger holds the measurements and one long whose bit ``i`` is set if
rule ``i`` failed. A policy is a versioned set of rules, i.e. a mask; applying one, or finding what a policy would keep
without one of its rules, is bitwise arithmetic on the ledger and reads no text again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.llm.common import fresh

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
WINDOW = 8
_word = re.compile(r"[^\x20\x09-\x0D]+").findall
_has_word = re.compile(r"[^\x20\x09-\x0D]").search
_SYMBOLS = "#*$%&|<>"


def repeated_words(words: list[str], width: int = WINDOW) -> int:
    """Words covered by a window of ``width`` (a power of two) words that occurs at least twice, first occurrence included."""
    if len(words) <= width:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    # Equal windows have equal sums below, so no equal sums means no repeated window.
    h, step = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 1
    h ^= h >> np.uint64(29)
    while step < width:
        h = h[:-step] * np.uint64(0xD6E8FEB86659FD93) + h[step:]
        step *= 2
    h.sort()
    if not (h[1:] == h[:-1]).any():
        return 0
    # Exact: number the distinct pairs of words, then of pairs, then of fours.
    step = 1
    while step < width:
        codes = ids[:-step] * (int(ids.max()) + 1) + ids[step:]
        _, ids, count = np.unique(codes, return_inverse=True, return_counts=True)
        step *= 2
    start = np.flatnonzero(count[ids] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + width, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measure_text(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = _word(text)
    lines = [x for x in text.split("\n") if _has_word(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, _SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


@F.pandas_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def measures(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([measure_text(t) for t in batch], columns=list(MEASURES), dtype="int64")


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``failed`` (SQL over the measurements) holds. A bit, once given, is never given to another rule."""

    bit: int
    name: str
    failed: str


RULES = (
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule(4, "short_words", "word_chars < 3 * n_words"),
    Rule(5, "long_words", "word_chars > 10 * n_words"),
)

#: Versions of the policy; a version is never changed, only added.
POLICIES = {
    1: ("few_words", "repeated_windows"),
    2: ("few_words", "repeated_windows", "symbols", "duplicate_lines", "short_words", "long_words"),
}
BASE, CURRENT = 1, 2


def mask(policy: int, without: str | None = None) -> int:
    return sum(1 << r.bit for r in RULES if r.name in POLICIES[policy] and r.name != without)


def passes(bits: Column, policy: int, without: str | None = None) -> Column:
    return bits.bitwiseAND(F.lit(mask(policy, without))) == 0


def ledger(docs: DataFrame, text: str = "text", into: str = "ledger") -> DataFrame:
    """``docs`` with a struct column ``into``: the measurements and ``bits``, the failed rules.

    A null or empty text measures 0 everywhere and so fails few_words. Rows are measured one by one: repeated rows get
    equal entries, an empty table gives none, and other columns pass through untouched (``into`` must be a new name).
    """
    (m,) = fresh(docs, "_measures")
    measured = docs.withColumn(m, measures(F.col(text)))
    bits = F.lit(0).cast("long")
    for r in RULES:
        failed = re.sub(r"\b[a-z]\w*", lambda x: f"`{m}`.{x[0]}", r.failed)
        bits = bits.bitwiseOR(F.when(F.expr(failed), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn(into, F.struct(*[F.col(f"`{m}`.{x}").alias(x) for x in MEASURES], bits.alias("bits"))).drop(m)


class LedgerTable:
    """A stored ledger: one row per document with its id, text hash, measurements and failure bits, added to batch by batch.

    Texts are measured when they are added and not again: policies and ablations, of versions made later, too, read the narrow
    table only. A batch stored again replaces its own rows. New rules need measurements that are stored already; a rule that
    was added after a batch was stored is worked out from them (``bits`` are made anew from the measurements when read).
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, docs: DataFrame, batch: int, doc_id: str = "doc_id", text: str = "text") -> None:
        slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
        ledger(slim).select("doc_id", "text_hash", "ledger.*").write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def entries(self) -> DataFrame:
        """All rows: batch, doc_id, text_hash, measurements, and bits by the rules as they are now."""
        fields = ", ".join(["doc_id long", "text_hash long", *(f"{m} long" for m in MEASURES), "bits long", "batch int"])
        stored = self.spark.read.schema(fields).parquet(self.path)
        bits = F.lit(0).cast("long")
        for r in RULES:
            bits = bits.bitwiseOR(F.when(F.expr(r.failed), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
        return stored.withColumn("bits", bits)

    def kept(self, policy: int = CURRENT) -> DataFrame:
        return self.entries().where(passes(F.col("bits"), policy))

    def ablations(self, policy: int = CURRENT) -> DataFrame:
        return ablations(self.entries(), policy, "bits")


def ablations(entries: DataFrame, policy: int = CURRENT, bits: str = "ledger.bits") -> DataFrame:
    """For each rule of a policy: documents failing it, kept by the policy, and kept if the policy lacked the rule.

    The ledger is first summed to one row per set of failed rules, of which there are few.
    """
    per_set = entries.groupBy(F.col(bits).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    b, used = F.col("bits"), [r for r in RULES if r.name in POLICIES[policy]]
    sums = per_set.agg(
        F.array(
            *[
                F.struct(
                    F.lit(r.name).alias("rule"),
                    total(b.bitwiseAND(F.lit(1 << r.bit)) != 0).alias("failed"),
                    total(passes(b, policy)).alias("kept"),
                    total(passes(b, policy, r.name)).alias("kept_without"),
                )
                for r in used
            ]
        ).alias("rows")
    )
    return sums.select(F.inline("rows"))


def keep(docs: DataFrame, policy: int = CURRENT) -> DataFrame:
    """The documents that pass the policy, with the columns they came with."""
    (entry,) = fresh(docs, "_ledger")
    return ledger(docs, into=entry).where(passes(F.col(entry)["bits"], policy)).select(*docs.columns)


def op9_rule_ledger(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    bits = F.col("ledger.bits")
    return ledger(docs).select(
        "doc_id",
        *[f"ledger.{m}" for m in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        (~passes(bits, BASE)).alias("base_failed"),
        passes(bits, CURRENT).alias("kept"),
        bits.alias("failed_bits"),
    )


OP9_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, unnest(generate_series(1, len(ws))) AS i, ws FROM d),
g AS (SELECT doc_id, i, CASE WHEN i + 7 <= len(ws) THEN array_to_string(ws[i:i + 7], ' ') END AS gram FROM p),
c AS (SELECT doc_id, i, CASE WHEN gram IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, gram) > 1 THEN 1 ELSE 0 END AS twice FROM g),
m AS (SELECT doc_id, max(twice) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS inside FROM c),
r AS (SELECT doc_id, sum(inside)::BIGINT AS n FROM m GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
k AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup FROM l
      WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
x AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum([length(w) for w in ws]), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines,
             coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
      FROM d LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)),
b AS (SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
       + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 8 ELSE 0 END
       + CASE WHEN word_chars < 3 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 10 * n_words THEN 32 ELSE 0 END)::BIGINT AS failed_bits FROM x)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed_bits & 3) <> 0 AS base_failed,
       failed_bits = 0 AS kept, failed_bits FROM b
"""
