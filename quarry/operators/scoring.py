"""Query-passage scorers: TF-IDF cosine, BM25, Laplace, Lidstone, Dirichlet.

Symbols per (query, passage) pair: f = count of the raw term among the
passage's whitespace tokens, dl = number of those tokens, k = occurrences of
the term in the query, ql = query length, df / N / avdl / V / PL from the
corpus (``operators.index``).

Derived candidates of a query side within the broadcast bound are scored whole
passage by whole passage, without a shuffle (``operators.passage_scores``).
Given candidates, larger query sides and repeated or null query ids take the
general shape, shared by all five scorers:

1. ``query_terms``: (qid, ql, term, k) - small; its distinct term set is
   broadcast after a row-count check (``bounded_broadcast``).
2. Passage tokens are exploded and semi-joined with that set *before*
   aggregation, so only query-term occurrences reach a shuffle
   ("semi-join reduction").
3. The per-pair sum is a ``groupBy(qid, pid)``; its partial aggregate runs
   map-side.

Every smoothed language model sums over *all* query terms, also those
absent from the passage. That sum is split into per-query constants, a
per-pair length term and a sparse sum over matching terms only, e.g.

    Laplace(q, d) = sum_{t: f>0} k*ln(f+1) - ql*ln(dl+V)

so no (candidate x query term) cross product is ever built.

Reference semantics kept on purpose: the cosine can exceed 1 (each repeated
query token is its own vector entry), BM25 counts k twice (as occurrences
and as qf), Lidstone's numerator is f/dl + eps, Dirichlet's background uses
document frequency (``background='cf'`` switches to collection frequency).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators.passage_scores import QuerySide, query_terms_task, score_task
from quarry.plans.execution import DEFAULT_BROADCAST_ROWS, bounded_broadcast, durable, scalar_row, ship_package
from quarry.sources.passage_index import PassageIndex, exploded


@dataclass
class ScoringParams:
    k1: float = 1.2
    k2: float = 100.0
    b: float = 0.75
    epsilon: float = 0.1         # Lidstone
    mu: float = 50.0             # Dirichlet
    background: str = "df"       # Dirichlet background statistic: 'df' or 'cf'
    # Corpus constants; None = computed from the passages.
    n_passages: int | None = None
    avdl: float | None = None
    total_words: int | None = None      # PL in the Dirichlet formula
    n_nonempty: int | None = None       # N of the query-side idf
    vocabulary_size: int | None = None  # V
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS


# Query-term lists up to this size are also pushed into the parquet scan of
# the posting tables as an IN filter (row-group pruning on the term-sorted
# files). Longer lists rely on the broadcast semi-join alone: a huge IN list
# costs more to plan than it saves.
PUSHDOWN_TERMS = 256


@dataclass
class Retrieval:
    """Scorers over one persisted ``PassageIndex`` and one query table.

    ``queries``: (qid, query); ``candidates`` (optional): (qid, pid, ord)
    pairs to score. Without it the candidates are the pairs sharing a raw
    query token with the passage's index terms.
    """

    index: PassageIndex
    queries: DataFrame
    candidates: DataFrame | None = None
    params: ScoringParams = field(default_factory=ScoringParams)

    def __post_init__(self):
        self._stats = None
        self._query_side_small = None
        self._pushdown = None
        self._qt = None
        self._cands = None
        self._whole = None
        self._side = None

    @property
    def passages(self) -> DataFrame:
        return self.index.passages

    def with_candidates(self, candidates: DataFrame) -> "Retrieval":
        r = Retrieval(self.index, self.queries, candidates, self.params)
        r._stats, r._query_side_small, r._pushdown = self._stats, self._query_side_small, self._pushdown
        r._qt = self._qt
        return r

    def close(self) -> None:
        """Free what the scorers keep in memory."""
        if self._qt is not None and self._query_side_small:
            self._qt.unpersist()
        self._qt, self._query_side_small = None, None

    def group_bound(self) -> int:
        """Upper bound on candidates per query: each is a distinct passage."""
        return int(self.index.stats()["n_passages"])

    # ------------------------------------------------------------------ stats
    def stats(self) -> dict:
        if self._stats is None:
            s = dict(self.index.stats())
            for key in ("n_passages", "avdl", "total_words", "n_nonempty", "vocabulary_size"):
                override = getattr(self.params, key)
                if override is not None:
                    s[key] = override
            if s["n_passages"] <= 0:
                raise ValueError("empty passage table")
            if self.params.n_passages is not None:
                top = scalar_row(self.index.doc_freq.agg(F.max("df").alias("m")))["m"] or 0
                if s["n_passages"] < top:
                    raise ValueError(f"n_passages={s['n_passages']} is below the largest document frequency {top}")
            self._stats = s
        return self._stats

    # ------------------------------------------------------------ query side
    def query_terms(self) -> DataFrame:
        """(qid, ql, term, k): raw whitespace tokens of each query with counts.

        The first call counts the table (the query-side size check) and keeps
        it cached when it is within the broadcast bound, so every later
        query-side join reads the cache instead of re-tokenising the queries.
        """
        if self._qt is None:
            arrays = self.queries.select("qid", T.ws_tokens("query").alias("_toks"))
            arrays = arrays.select("qid", F.size("_toks").alias("ql"), "_toks")
            rows = arrays.select("qid", "ql", F.explode_outer("_toks").alias("term")).where(F.col("term").isNotNull())
            qt = rows.groupBy("qid", "ql", "term").agg(F.count(F.lit(1)).alias("k"))
            if self._query_side_small is None:
                cached = qt.cache()
                self._query_side_small = cached.count() <= self.params.broadcast_rows
                if self._query_side_small:
                    qt = cached
                else:
                    cached.unpersist()
            self._qt = qt
        return self._qt

    def query_lengths(self) -> DataFrame:
        """(qid, ql) for every query, including queries without tokens."""
        return self.queries.select("qid", F.size(T.ws_tokens("query")).alias("ql"))

    def small(self, query_side: DataFrame) -> DataFrame:
        """Broadcast a query-side table when the query side is small.

        Every query-side table (term set, per-query constants, df of query
        terms, query vectors) has at most as many rows as ``query_terms``,
        so one row count of that table bounds them all.
        """
        self.query_terms()  # runs the size check once
        return F.broadcast(query_side) if self._query_side_small else query_side

    def query_term_set(self) -> DataFrame:
        return self.small(self.query_terms().select("term").distinct())

    def _restrict(self, table: DataFrame) -> DataFrame:
        """Rows of query terms only (posting blocks, df): IN-list pushdown when short, semi-join always."""
        if self._pushdown is None:
            terms = self.query_terms().select("term").distinct().limit(PUSHDOWN_TERMS + 1).collect()
            self._pushdown = [r.term for r in terms] if len(terms) <= PUSHDOWN_TERMS else []
        if self._pushdown:
            quoted = ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in self._pushdown)
            table = table.where(F.expr(f"term IN ({quoted})"))
        return table.join(self.query_term_set(), "term", "left_semi")

    # ---------------------------------------------------------- passage side
    def passage_lengths(self) -> DataFrame:
        """(pid, dl, wc): whitespace length and single-space length."""
        return self.index.docs.select("pid", "dl", F.col("word_count").alias("wc"))

    def _forward(self) -> DataFrame:
        """Counted terms of the passages; of given candidates' passages only."""
        rows = self.index.forward
        if self.candidates is None:
            return rows
        return rows.join(bounded_broadcast(self.candidates.select("pid").distinct(), self.params.broadcast_rows), "pid", "left_semi")

    def raw_term_counts(self) -> DataFrame:
        """(pid, dl, term, f) for query terms only (raw whitespace tokens)."""
        return self._restrict(exploded(self._forward(), "raw", "f", ["pid", "dl"])).select("pid", "dl", "term", "f")

    def index_term_counts(self) -> DataFrame:
        """(pid, word_count, term, tf) from the index analyzer, query terms only."""
        return self._restrict(exploded(self._forward(), "terms", "tf", ["pid", "word_count"])).select("pid", "word_count", "term", "tf")

    def query_term_df(self) -> DataFrame:
        """(term, df, cf) of query terms that are index terms."""
        return self._restrict(self.index.doc_freq).select("term", "df", "cf")

    def derived_candidates(self) -> DataFrame:
        """(qid, pid, ord): pairs where a raw query token is an index term of the passage."""
        if self.by_passage():
            return self.passage_scores([])
        hits = self.index_term_counts().select("pid", "term")
        qt = self.small(self.query_terms().select("qid", "term"))
        pairs = hits.join(qt, "term").select("qid", "pid").distinct()
        return pairs.join(self.index.docs.select("pid", "ord"), "pid")

    def candidate_pairs(self) -> DataFrame:
        """Candidates to score; derived ones that take a shuffle are materialised once and shared by every scorer."""
        if self.candidates is not None:
            return self.candidates.select("qid", "pid", "ord")
        if self.by_passage():
            return self.derived_candidates()
        if self._cands is None:
            self._cands = durable(self.derived_candidates())
        return self._cands

    # --------------------------------------------------------- per passage
    def by_passage(self) -> bool:
        """Whether tasks can score whole passages: derived candidates, a small query side, every qid once."""
        if self.candidates is not None:
            return False
        if self._whole is None:
            self.query_terms()  # runs the size check once
            odd = lambda: self.queries.groupBy("qid").count().where("qid is null or count > 1").limit(1).count()
            self._whole = bool(self._query_side_small and not odd())
        return self._whole

    def _query_side(self) -> QuerySide:
        if self._side is None:
            stat = "df" if self.params.background == "df" else "cf"
            freq = self.query_term_df().select("term", "df", F.col(stat).alias("stat")).toArrow()
            self._side = QuerySide.of(self.query_terms().toArrow(), freq, self.stats(), self.params)
        return self._side

    def passage_scores(self, names: list[str], hits: DataFrame | None = None, good: DataFrame | None = None) -> DataFrame:
        """(qid, pid, ord, *names) of the derived candidates, in one pass over the passages.
        With ``hits`` (qid, pid) of relevant pairs and ``good`` (pid) of passages
        of grade 1: also relevancy and grade."""
        side, spark = self._query_side(), self.index.spark
        columns, lists, joined = ["pid", "ord", "terms", "tf"], [("terms", "tf")], []
        rows = self.index.forward.where(F.col("pid").isNotNull())
        if "tfidf_cosine" in names:
            columns += ["word_count", "pnorm"]
            joined.append(self.index.doc_norms)
        if set(names) - {"tfidf_cosine"}:
            columns += ["raw", "f", "dl"]
            lists.append(("raw", "f"))
        if hits is not None:
            columns += ["_hits", "_good"]
            joined.append(hits.groupBy("pid").agg(F.collect_set("qid").alias("_hits")))
            joined.append(good.select("pid").distinct().withColumn("_good", F.lit(True)))
        ship_package(spark)
        sent, small = spark.sparkContext.broadcast(side), [t.count() <= self.params.broadcast_rows for t in joined]
        if not all(small):  # passages move: with their query terms only
            rows = rows.select("pid", "ord", "word_count", "dl", *[c for pair in lists for c in pair])
            rows = rows.mapInArrow(query_terms_task(sent, lists), rows.schema)
        for table, whole in zip(joined, small, strict=True):
            rows = rows.join(F.broadcast(table) if whole else table, "pid", "left")
        if hits is not None:
            rows = rows.withColumn("_good", F.col("_good").isNotNull())
        kind = {**dict(self.queries.select("qid").dtypes), **dict(rows.select("pid", "ord").dtypes)}
        schema = ", ".join([f"{c} {kind[c]}" for c in ("qid", "pid", "ord")] + [f"{x} double" for x in [*names, *(["relevancy", "grade"] if hits is not None else [])]])
        return rows.select(*columns).mapInArrow(score_task(sent, list(names), hits is not None), schema)

    # ------------------------------------------------------------ per term
    def _matches(self) -> DataFrame:
        """(qid, pid, dl, term, k, f) for query terms present (raw) in the passage."""
        qt = self.small(self.query_terms().select("qid", "term", "k"))
        return self.raw_term_counts().join(qt, "term")

    def _with_candidates(self, sparse: DataFrame, value: str = "score") -> DataFrame:
        """Left-join sparse per-pair sums onto the candidates; absent -> 0."""
        out = self.candidate_pairs().join(sparse, ["qid", "pid"], "left")
        return out.select("qid", "pid", "ord", F.coalesce(F.col(value), F.lit(0.0)).alias(value))

    # -------------------------------------------------------------- scorers
    def bm25_tf_part(self, f: Column, dl: Column) -> Column:
        """Grows with the term count, falls with the passage length."""
        p = self.params
        return f * (p.k1 + 1) / (F.lit(p.k1) * (1 - p.b + p.b * dl / F.lit(float(self.stats()["avdl"]))) + f)

    def bm25_query_weights(self) -> DataFrame:
        """(qid, term, w, df): a match contributes w times its tf part; negative for terms of most passages."""
        n, k2 = float(self.stats()["n_passages"]), self.params.k2
        k = F.col("k")
        idf = F.log((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
        terms = self.query_terms().join(self.small(self.query_term_df().select("term", "df")), "term")
        return terms.select("qid", "term", (k * idf * (k * (k2 + 1) / (F.lit(k2) + k))).alias("w"), "df")

    def bm25(self) -> DataFrame:
        """(qid, pid, ord, score): Okapi BM25 with k1, k2, b; index terms only."""
        m = self.raw_term_counts().join(self.small(self.bm25_query_weights().select("qid", "term", "w")), "term")
        contrib = F.col("w") * self.bm25_tf_part(F.col("f"), F.col("dl"))
        sparse = m.groupBy("qid", "pid").agg(F.sum(contrib).alias("score"))
        return self._with_candidates(sparse)

    def tfidf_passage_vectors(self) -> DataFrame:
        """(pid, term, weight): tf = tf/word_count, idf = log10(N / df), full index."""
        s = self.stats()
        post = self.index.postings
        n = float(s["n_passages"])
        w = (F.col("tf") / F.col("word_count")) * F.log10(F.lit(n) / F.col("df"))
        return self.index.with_df(post).select("pid", "term", w.alias("weight"))

    def tfidf_query_vectors(self) -> DataFrame:
        """(qid, term, k, weight): tf = k/ql, idf = log10(N1 / df); k entries per term."""
        s = self.stats()
        n1 = float(s["n_nonempty"])
        qt = self.query_terms().join(self.query_term_df().select("term", "df"), "term")
        w = (F.col("k") / F.col("ql")) * F.log10(F.lit(n1) / F.col("df"))
        return qt.select("qid", "term", "k", w.alias("weight"))

    def tfidf_cosine(self) -> DataFrame:
        """(qid, pid, ord, score): cosine of the two TF-IDF vectors (0 if a norm is 0)."""
        s = self.stats()
        n = float(s["n_passages"])
        qv = self.tfidf_query_vectors()
        qnorm = qv.groupBy("qid").agg(F.sqrt(F.sum(F.col("k") * F.col("weight") ** 2)).alias("qnorm"))
        # Passage norms need every index term of the passage: kept in the index.
        pnorm = self.index.doc_norms
        df = self.small(self.query_term_df().select("term", "df"))
        wd = (F.col("tf") / F.col("word_count")) * F.log10(F.lit(n) / F.col("df"))
        pq = self.index_term_counts().join(df, "term").select("pid", "term", wd.alias("wd"))
        qb = self.small(qv.select("qid", "term", "k", "weight"))
        dot = pq.join(qb, "term").groupBy("qid", "pid").agg(
            F.sum(F.col("k") * F.col("weight") * F.col("wd")).alias("dot"))
        pairs = self.candidate_pairs().join(dot, ["qid", "pid"], "left") \
            .join(qnorm, "qid", "left").join(pnorm, "pid", "left")
        denom = F.col("qnorm") * F.col("pnorm")
        score = F.when(F.coalesce(denom, F.lit(0.0)) == 0, F.lit(0.0)) \
            .otherwise(F.coalesce(F.col("dot"), F.lit(0.0)) / denom)
        return pairs.select("qid", "pid", "ord", score.alias("score"))

    def _pair_frame(self) -> DataFrame:
        """(qid, pid, ord, dl, ql) for every candidate pair."""
        return (self.candidate_pairs()
                .join(self.passage_lengths().select("pid", "dl"), "pid")
                .join(self.query_lengths(), "qid"))

    def laplace(self) -> DataFrame:
        """sum over all query tokens of ln((f + 1) / (dl + V))."""
        v = float(self.stats()["vocabulary_size"])
        sparse = self._matches().groupBy("qid", "pid").agg(
            F.sum(F.col("k") * F.log(F.col("f") + 1.0)).alias("hit"))
        pairs = self._pair_frame().join(sparse, ["qid", "pid"], "left")
        score = F.coalesce(F.col("hit"), F.lit(0.0)) - F.col("ql") * F.log(F.col("dl") + F.lit(v))
        return pairs.select("qid", "pid", "ord", score.alias("score"))

    def lidstone(self) -> DataFrame:
        """sum over all query tokens of ln((f/dl + eps) / (dl + eps*V)); f/dl = 0 when dl = 0."""
        eps = self.params.epsilon
        v = float(self.stats()["vocabulary_size"])
        sparse = self._matches().groupBy("qid", "pid").agg(
            F.sum(F.col("k") * (F.log(F.col("f") / F.col("dl") + eps) - F.log(F.lit(eps)))).alias("hit"))
        pairs = self._pair_frame().join(sparse, ["qid", "pid"], "left")
        score = (F.coalesce(F.col("hit"), F.lit(0.0))
                 + F.col("ql") * (F.log(F.lit(eps)) - F.log(F.col("dl") + F.lit(eps * v))))
        return pairs.select("qid", "pid", "ord", score.alias("score"))

    def dirichlet(self) -> DataFrame:
        """sum over query tokens that are index terms of ln(f/(dl+mu) + mu*bg/(PL*(dl+mu)))."""
        mu = self.params.mu
        pl = float(self.stats()["total_words"])
        stat = "df" if self.params.background == "df" else "cf"
        bg = (F.lit(mu) * F.col(stat) / F.lit(pl)).alias("bg")
        dfq = self.query_term_df().select("term", bg)
        # Per-query constants over the query's index terms.
        per_query = (self.query_terms().join(self.small(dfq), "term")
                     .groupBy("qid").agg(F.sum(F.col("k") * F.log("bg")).alias("a_q"),
                                         F.sum("k").alias("b_q")))
        sparse = (self._matches().join(self.small(dfq), "term")
                  .groupBy("qid", "pid")
                  .agg(F.sum(F.col("k") * (F.log(F.col("f") + F.col("bg")) - F.log("bg"))).alias("hit")))
        pairs = (self.candidate_pairs().join(self.passage_lengths().select("pid", "dl"), "pid")
                 .join(per_query, "qid", "left")
                 .join(sparse, ["qid", "pid"], "left"))
        score = (F.coalesce(F.col("a_q"), F.lit(0.0))
                 - F.coalesce(F.col("b_q"), F.lit(0)) * F.log(F.col("dl") + F.lit(mu))
                 + F.coalesce(F.col("hit"), F.lit(0.0)))
        return pairs.select("qid", "pid", "ord", score.alias("score"))

    def score(self, scorer: str) -> DataFrame:
        if self.by_passage():
            return self.passage_scores([scorer]).withColumnRenamed(scorer, "score")
        return getattr(self, scorer)()

    def all_scores(self) -> DataFrame:
        """(qid, pid, ord, tfidf_cosine, bm25, laplace, lidstone, dirichlet) in one frame.

        The four term-matching scorers share one pass over the matches (one
        aggregate with four sums); the cosine adds its index-side dot
        product. Same formulas as the single-scorer methods.
        """
        if self.by_passage():
            return self.passage_scores(list(SCORERS))
        s, p = self.stats(), self.params
        n, v = float(s["n_passages"]), float(s["vocabulary_size"])
        pl = float(s["total_words"])
        eps, mu = p.epsilon, p.mu
        stat = "df" if p.background == "df" else "cf"
        dfq = self.small(self.query_term_df().select(
            "term", "df", (F.lit(mu) * F.col(stat) / F.lit(pl)).alias("bg")))
        m = self._matches().join(dfq, "term", "left")
        k, f, dl = F.col("k"), F.col("f"), F.col("dl")
        idf = F.log((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
        tf_part = self.bm25_tf_part(f, dl)
        q_part = k * (p.k2 + 1) / (F.lit(p.k2) + k)
        known = F.col("df").isNotNull()
        sparse = m.groupBy("qid", "pid").agg(
            F.sum(F.when(known, k * idf * tf_part * q_part)).alias("_bm"),
            F.sum(k * F.log(f + 1.0)).alias("_la"),
            F.sum(k * (F.log(f / dl + eps) - F.log(F.lit(eps)))).alias("_li"),
            F.sum(F.when(known, k * (F.log(f + F.col("bg")) - F.log("bg")))).alias("_di"))
        per_query = (self.query_terms().join(self.small(dfq.select("term", "bg")), "term")
                     .groupBy("qid").agg(F.sum(k * F.log("bg")).alias("a_q"), F.sum("k").alias("b_q")))
        cos = self.tfidf_cosine().select("qid", "pid", F.col("score").alias("tfidf_cosine"))
        pairs = (self._pair_frame().join(per_query, "qid", "left")
                 .join(sparse, ["qid", "pid"], "left").join(cos, ["qid", "pid"], "left"))
        z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
        return pairs.select(
            "qid", "pid", "ord", F.coalesce("tfidf_cosine", F.lit(0.0)).alias("tfidf_cosine"),
            z("_bm").alias("bm25"),
            (z("_la") - F.col("ql") * F.log(F.col("dl") + F.lit(v))).alias("laplace"),
            (z("_li") + F.col("ql") * (F.log(F.lit(eps)) - F.log(F.col("dl") + F.lit(eps * v)))).alias("lidstone"),
            (z("a_q") - F.coalesce(F.col("b_q"), F.lit(0)) * F.log(F.col("dl") + F.lit(mu)) + z("_di"))
            .alias("dirichlet"))


SCORERS = ("tfidf_cosine", "bm25", "laplace", "lidstone", "dirichlet")
