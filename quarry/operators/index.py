"""Corpus statistics and the flat inverted index.

The index is a table, not a dictionary:

    postings(term, pid, tf, word_count)     one row per (term, passage)
    document_frequency(term, df, cf)        one row per term

``postings`` explodes each passage's tokens and counts them per
(pid, word_count, term). All tokens of a passage live in one row, hence in
one map task, so the partial aggregate already yields the final counts and
the shuffle carries postings, not tokens. A frequent term is spread over
many partitions because ``pid`` is part of the key.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators.ranking import first_wins, global_rank
from quarry.plans.execution import scalar_row


def passage_table(passages: DataFrame) -> DataFrame:
    """(pid, passage, ord, word_count): distinct pid, first row in ``ord`` wins."""
    dedup = first_wins(passages.select("pid", "passage", "ord"), ["pid"], "ord")
    return dedup.withColumn("word_count", T.word_count("passage"))


def dedup_by_text(passages: DataFrame) -> DataFrame:
    """First-wins de-duplication keyed by passage text.

    The key is a SHA-256 digest of the text, so the shuffle moves 64-byte keys
    rather than whole passages. Returns (pid, word_count, n_copies).
    """
    keyed = passages.select(
        F.sha2(F.coalesce("passage", F.lit("")), 256).alias("_key"),
        "pid", "ord", T.word_count("passage").alias("word_count"))
    return keyed.groupBy("_key").agg(
        F.min_by(F.struct("pid", "word_count"), F.col("ord")).alias("_first"),
        F.count(F.lit(1)).alias("n_copies"),
    ).select(F.col("_first.pid").alias("pid"), F.col("_first.word_count").alias("word_count"),
             "n_copies")


def index_token_rows(passages: DataFrame) -> DataFrame:
    """(pid, word_count, term): one row per index token occurrence."""
    arrays = passages.select("pid", T.word_count("passage").alias("word_count"),
                             T.index_tokens("passage").alias("_toks"))
    # explode_outer + null filter avoids Catalyst's inferred size(_toks) > 0
    # filter, which would tokenise every passage a second time.
    return arrays.select("pid", "word_count", F.explode_outer("_toks").alias("term")).where(F.col("term").isNotNull())


def postings(passages: DataFrame) -> DataFrame:
    """Inverted index rows (term, pid, tf, word_count)."""
    return (index_token_rows(passages)
            .groupBy("pid", "word_count", "term")
            .agg(F.count(F.lit(1)).alias("tf"))
            .select("term", "pid", "tf", "word_count"))


def document_frequency(post: DataFrame) -> DataFrame:
    """(term, df, cf): passages containing the term and its total count."""
    return post.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def corpus_stats_frame(passages: DataFrame) -> DataFrame:
    """One-row statistics in a single aggregate over the exploded token stream.

    ``posexplode_outer`` keeps empty passages (one row, null term); the row at
    position 0 (or null) carries the per-passage values exactly once.
    """
    arrays = passages.select(T.word_count("passage").alias("wc"), T.index_tokens("passage").alias("_toks"))
    rows = arrays.select("wc", F.posexplode_outer("_toks").alias("pos", "term"))
    first = F.col("pos").isNull() | (F.col("pos") == 0)
    agg = rows.agg(
        F.sum(F.when(first, 1).otherwise(0)).cast("long").alias("n_passages"),
        F.sum(F.when(first, F.col("wc")).otherwise(0)).cast("long").alias("total_words"),
        F.sum(F.when(F.col("pos") == 0, 1).otherwise(0)).cast("long").alias("n_nonempty"),
        F.count("term").alias("total_tokens"),
        F.count_distinct("term").alias("vocabulary_size"),
    )
    return agg.select("n_passages", (F.col("total_words") / F.col("n_passages")).alias("avdl"),
                      "total_words", "n_nonempty", "total_tokens", "vocabulary_size")


def corpus_stats(passages: DataFrame) -> dict:
    """The statistics of ``corpus_stats_frame`` as driver scalars (one row)."""
    base = scalar_row(corpus_stats_frame(passages))
    for k in ("n_passages", "total_words", "n_nonempty", "total_tokens", "vocabulary_size"):
        base[k] = int(base[k] or 0)
    base["avdl"] = float(base["avdl"] or 0.0)
    return base


def term_counts(passages: DataFrame) -> DataFrame:
    """(term, count) over all index tokens of the corpus."""
    return index_token_rows(passages).groupBy("term").agg(F.count(F.lit(1)).alias("count"))


def vocabulary(passages: DataFrame) -> DataFrame:
    """(term, count, normalised_frequency, rank); rank by count desc, then term.

    The reference breaks count ties by first occurrence in the text; this
    engine breaks them by term, which is deterministic under any partitioning.
    """
    return vocabulary_from_counts(term_counts(passages))


def vocabulary_from_counts(counts: DataFrame) -> DataFrame:
    """Vocabulary from (term, count) rows, e.g. the index's collection frequencies."""
    total = scalar_row(counts.agg(F.sum("count").alias("t")))["t"] or 0
    ranked = global_rank(counts, [F.col("count").desc(), F.col("term")])
    return ranked.select("term", "count", (F.col("count") / F.lit(float(max(total, 1)))).alias("normalised_frequency"),
                         "rank")


def harmonic_number(n: int) -> float:
    """H_n = sum_{i=1..n} 1/i; exact summation below 10^5, asymptotic series above
    (its error, below 1/(252 n^6), is far under double precision there)."""
    if n <= 0:
        return 0.0
    if n <= 100_000:
        return math.fsum(1.0 / i for i in range(1, n + 1))
    euler_gamma = 0.57721566490153286060651209
    inv = 1.0 / n
    return math.log(n) + euler_gamma + inv / 2 - inv ** 2 / 12 + inv ** 4 / 120


def zipf(passages: DataFrame) -> DataFrame:
    """Vocabulary next to Zipf's law: zipf = 1 / (rank * H_T), T = total tokens."""
    total_tokens = scalar_row(index_token_rows(passages).agg(F.count(F.lit(1)).alias("t")))["t"]
    return zipf_from_counts(term_counts(passages), int(total_tokens or 0))


def zipf_from_counts(counts: DataFrame, total_tokens: int) -> DataFrame:
    vocab = vocabulary_from_counts(counts)
    hn = harmonic_number(int(total_tokens))
    return vocab.select("rank", "term", "normalised_frequency",
                        (F.lit(1.0) / (F.col("rank") * F.lit(hn))).alias("zipf"))
