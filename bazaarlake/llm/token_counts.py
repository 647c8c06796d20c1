"""Token counts from the exact histogram of encoded lengths.

Documents are encoded once and counted by length. With suffix sums over that histogram, every question about a context
limit is a lookup: documents and tokens beyond it, tokens that remain when longer texts are truncated, quantiles. The
histogram has a row per length that occurs, however many documents there are.
"""

from __future__ import annotations

import base64
import importlib.util
import os
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.llm.common import cut, table

#: Words with their leading space, runs of digits or of other marks, white space: the split that byte_bpe_50k was made with.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "byte_bpe_50k.tiktoken"
STEP = 1024


def vocabulary_path() -> str:
    """The vocabulary file: BAZAARLAKE_VOCABULARY, or the one that the box's tokenizer package has."""
    if path := os.environ.get("BAZAARLAKE_VOCABULARY"):
        return path
    home = importlib.util.find_spec("public_tokenizers").submodule_search_locations[0]
    return os.path.join(home, VOCABULARY)


@lru_cache(maxsize=2)
def encoder(path: str):
    """The encoder of a file of ranks, loaded once in each worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded_length(path: str):
    """A column function: tokens of a text. Null and empty texts have none; strings of special tokens are ordinary text."""

    @F.arrow_udf(T.LongType())
    def length(texts: pa.Array) -> pa.Array:
        encode = encoder(path).encode_ordinary
        return pa.array([len(encode(t)) if t else 0 for t in texts.to_pylist()], pa.int64())

    return length


def histogram(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """(length, docs): documents by encoded length. Repeated rows count each; an empty table gives no rows."""
    lengths = docs.select(encoded_length(path or vocabulary_path())(F.col(text)).alias("length"))
    return lengths.groupBy("length").agg(F.count(F.lit(1)).alias("docs"))


def with_suffix_sums(hist: DataFrame) -> DataFrame:
    """Adds, for each length L that occurs: ``docs_from`` and ``tokens_from`` (documents of L tokens or more, and their
    tokens), ``tokens_cut`` (all tokens left when texts are truncated to L), ``quantile`` (share of documents of at most L).

    Sums run within steps of 1,024 lengths, then over the steps' sums, so no task sees the whole histogram.
    """
    step = F.floor(F.col("length") / STEP)
    tokens = F.col("length") * F.col("docs")
    down = Window.partitionBy("step").orderBy(F.col("length").desc())
    inner = hist.withColumn("step", step).withColumn("docs_in", F.sum("docs").over(down)).withColumn("tokens_in", F.sum(tokens).over(down))
    steps = hist.groupBy(step.alias("step")).agg(F.sum("docs").alias("d"), F.sum(tokens).alias("t"))
    after = Window.partitionBy(F.lit(1)).orderBy(F.col("step").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    steps = steps.select(
        "step",
        F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_after"),
        F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_after"),
        F.sum("d").over(everything).alias("d_all"),
        F.sum("t").over(everything).alias("t_all"),
    )
    docs_from, tokens_from = F.col("docs_in") + F.col("d_after"), F.col("tokens_in") + F.col("t_after")
    return inner.join(steps, "step").select(
        "length",
        "docs",
        docs_from.alias("docs_from"),
        tokens_from.alias("tokens_from"),
        (F.col("t_all") - tokens_from + F.col("length") * docs_from).alias("tokens_cut"),
        ((F.col("d_all") - docs_from + F.col("docs")) / F.col("d_all")).alias("quantile"),
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """For each context limit: documents longer than it, and all tokens left when texts are truncated to it.

    A limit need not occur as a length. Texts beyond it are those of the next length that occurs.
    """
    over = lambda n, c: F.coalesce(F.max(F.when(F.col("length") > n, F.col(c))), F.lit(0))
    total = F.coalesce(F.max("tokens_from"), F.lit(0))
    rows = [
        F.struct(
            F.lit(n).cast("long").alias("limit"),
            over(n, "docs_from").alias("docs_over"),
            (total - over(n, "tokens_from") + n * over(n, "docs_from")).alias("tokens_cut"),
        )
        for n in limits
    ]
    return sums.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def quantile_length(sums: DataFrame, share: float) -> DataFrame:
    """The smallest length that at least ``share`` of the documents do not exceed; no row for an empty table."""
    return sums.where(F.col("quantile") >= share).agg(F.min("length").alias("length")).where("length IS NOT NULL")


def op8_length_histogram(spark, sf_dir):
    return with_suffix_sums(cut(histogram(table(spark, sf_dir, "documents").select("text"))))  # texts are encoded once
