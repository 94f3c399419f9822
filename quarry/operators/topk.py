"""Top-k BM25 by block-max pruning: exact, without scoring every candidate.

A posting block's largest term count and shortest passage bound what any of its
postings can add to a score. With them, and a threshold per query that at
least k passages reach, most blocks need not be decoded:

1. Probe: a query's terms of the largest bounds are read, together up to
   ``PROBE * k`` postings (the first in any case). The k passages that score best on them are scored in
   full; the k-th best full score is the query's threshold.
2. Essential terms: terms in falling order of their bounds; those at the end whose
   bounds together stay below the threshold cannot lift a passage over it.
   Frequent terms have small (or negative) weights, so the long lists are
   the ones left out.
3. A block of an essential term is left alone if its own bound plus the bounds
   of the query's other terms stays below the threshold.
4. Passages whose essential score plus the rest's bounds reaches the threshold
   survive; only blocks that may hold a survivor are read of the other lists
   (term and id range, joined by buckets as wide as the term's average block).

A query without k passages of positive score has no threshold: all its
candidates are scored, those with score 0 or less included. Ties are
broken by ``ord``; thresholds are lowered by a margin wider than the rounding of scores.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.ranking import score_key, top_k_within
from quarry.operators.scoring import Retrieval
from quarry.plans.execution import durable
from quarry.sources.posting_blocks import BLOCK, decode

#: Postings read to find a query's threshold, as a multiple of k.
PROBE = 64
#: Relative margin between sums of doubles in different orders.
MARGIN = 1e-7


@dataclass
class BlockMaxTopK:
    """The top ``k`` of every query of ``r``. ``read`` collects the blocks that
    were decoded, (term, first_pid) for each step, for inspection."""

    r: Retrieval
    k: int
    probe: int = PROBE

    def __post_init__(self):
        if self.r.candidates is not None:
            raise ValueError("a given candidate set is scored in full; pruning needs the derived one")
        self.read: dict[str, DataFrame] = {}
        self.unpruned = 0

    def _terms(self) -> DataFrame:
        """(qid, term, w, bound, width): weight, largest contribution, and ids an average block spans."""
        part = self.r.bm25_tf_part(F.col("max_count"), F.col("min_len"))
        lists = self.blocks.groupBy("term").agg(F.max(part).alias("part"), F.sum("n").alias("postings"),
                                                F.min("first_pid").alias("lo"), F.max("last_pid").alias("hi"))
        width = F.expr(f"greatest(1, ((hi - lo + 1) * {BLOCK}) div postings)")
        weights = self.r.small(self.r.bm25_query_weights().select("qid", "term", "w"))
        return lists.join(weights, "term").select("qid", "term", "w", "postings", width.alias("width"),
                                                  (F.greatest("w", F.lit(0.0)) * F.col("part")).alias("bound"))

    def _decoded(self, step: str, wanted: DataFrame) -> DataFrame:
        """(term, pid, part) of the blocks ``wanted`` (term, first_pid)."""
        self.read[step] = wanted
        rows = decode(self.blocks.join(wanted, ["term", "first_pid"], "left_semi"), "f", "dl")
        return rows.select("term", "pid", self.r.bm25_tf_part(F.col("f"), F.col("dl")).alias("part"))

    def _sums(self, postings: DataFrame, terms: DataFrame) -> DataFrame:
        """(qid, pid, s): contributions of ``terms`` (qid, term, w)."""
        rows = postings.join(self.r.small(terms.select("qid", "term", "w")), "term")
        return rows.groupBy("qid", "pid").agg(F.sum(F.col("w") * F.col("part")).alias("s"))

    def _contributions(self, step: str, pairs: DataFrame, terms: DataFrame) -> DataFrame:
        """(qid, pid, s): what ``terms`` add to the few ``pairs`` (qid, pid), reading only blocks that may hold them."""
        rows = pairs.select("qid", "pid").join(self.r.small(terms.select("qid", "term", "w", "width")), "qid").withColumn(
            "bucket", F.expr("pid div width"))
        width = self.r.small(terms.select("term", "width").distinct())
        spans = self.blocks.select("term", "first_pid", "last_pid").join(width, "term").select(
            "term", "first_pid", F.explode(F.sequence(F.expr("first_pid div width"), F.expr("last_pid div width"))).alias("bucket"))
        wanted = spans.join(rows.select("term", "bucket").distinct(), ["term", "bucket"], "left_semi").select("term", "first_pid").distinct()
        hits = rows.join(self._decoded(step, wanted), ["term", "pid"])
        return hits.groupBy("qid", "pid").agg(F.sum(F.col("w") * F.col("part")).alias("s"))

    def _probed(self, terms: DataFrame) -> DataFrame:
        """(qid, threshold) of the queries with at least k passages above 0."""
        order = Window.partitionBy("qid").orderBy(F.desc("bound"), "term").rowsBetween(Window.unboundedPreceding, -1)
        probes = durable(terms.withColumn("before", F.coalesce(F.sum("postings").over(order), F.lit(0)))
                         .where(f"bound > 0 and (before = 0 or before + postings <= {self.probe * self.k})"))
        wanted = self.blocks.join(self.r.small(probes.select("term").distinct()), "term", "left_semi").select("term", "first_pid")
        partial = self._sums(self._decoded("probe", wanted), probes)
        seeds = durable(top_k_within(partial, ["qid"], [F.desc("s"), "pid"], self.k).select("qid", "pid"))
        full = self._contributions("seeds", seeds, terms)
        return full.groupBy("qid").agg(F.min("s").alias("t"), F.count("*").alias("n")).where(f"n >= {self.k} and t > 0").select(
            "qid", (F.col("t") * (1 - MARGIN) - MARGIN).alias("threshold"))

    def run(self) -> DataFrame:
        """(qid, pid, ord, score, rank)"""
        # read by every step; kept while the steps run
        self.blocks = self.r._restrict(self.r.index.raw_blocks).cache()
        terms = durable(self._terms())
        threshold = durable(self._probed(terms))
        every = terms.join(self.r.small(threshold), "qid")
        rising = Window.partitionBy("qid").orderBy("bound", "term").rowsBetween(Window.unboundedPreceding, 0)
        whole = Window.partitionBy("qid")
        every = durable(every.withColumns({"below": F.sum("bound").over(rising), "all": F.sum("bound").over(whole)}))
        essential, rest = every.where("below >= threshold"), every.where("below < threshold")

        block_part = self.r.bm25_tf_part(F.col("max_count"), F.col("min_len"))
        wanted = (self.blocks.select("term", "first_pid", block_part.alias("block_part"))
                  .join(self.r.small(essential.select("term", "w", "bound", "all", "threshold")), "term")
                  .where("greatest(w, 0d) * block_part + all - bound >= threshold").select("term", "first_pid").distinct())
        partial = self._sums(self._decoded("essential", wanted), essential)
        left = every.groupBy("qid").agg(F.max("threshold").alias("threshold"), F.max(F.when(F.col("below") < F.col("threshold"), F.col("below"))).alias("rest"))
        survivors = durable(partial.join(self.r.small(left), "qid").where("s + coalesce(rest, 0d) >= threshold").select("qid", "pid", "s"))
        more = self._contributions("rest", survivors, rest).withColumnRenamed("s", "more")
        scored = survivors.join(more, ["qid", "pid"], "left").select("qid", "pid", (F.col("s") + F.coalesce("more", F.lit(0.0))).alias("score"))
        scored = durable(scored.join(self.r.index.docs.select("pid", "ord"), "pid").select("qid", "pid", "ord", "score"))
        self.blocks.unpersist()

        others = durable(self.r.queries.join(threshold.select("qid"), "qid", "left_anti"))
        self.unpruned = others.count()
        if self.unpruned:
            scored = scored.unionByName(Retrieval(self.r.index, others, params=self.r.params).score("bm25"))
        return top_k_within(scored, ["qid"], [score_key("score"), F.col("ord")], self.k)


def bm25_top(r: Retrieval, k: int) -> DataFrame:
    """The k best candidates of every query by BM25, ranks included."""
    return BlockMaxTopK(r, k).run()
