"""Registered queries: name -> f(spark, sf_dir) -> DataFrame.

Each query reads the fixture tables whole and returns plain scalar columns
(token lists are space-joined strings, vectors are long-format rows) with
doubles rounded to 6 places, so results compare value-by-value with the
DuckDB statements in ``quarry.plans.oracle_sql``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import boundaries as B
from quarry.operators import evaluation as E
from quarry.operators import factorised as FX
from quarry.operators import features as X
from quarry.operators import logistic as L
from quarry.operators import index as I
from quarry.operators import pairwise as PW
from quarry.operators.ranking import WINDOW_GROUP_ROWS, global_rank, prefix_within, rank_by_score, score_key, top_k_within
from quarry.operators.scoring import SCORERS, Retrieval
from quarry.operators.topk import bm25_top
from quarry.plans import learned as LR
from quarry.plans.execution import durable, ensure_checkpoint_dir, release_shuffles, stored, table_version
from quarry.session import table_path
from quarry.sources import files, tables
from quarry.sources.labelled import contained_pairs, good_passages, label_candidates
from quarry.sources.passage_index import PassageIndex, index_for, one_per_pid


def r6(c: Column | str) -> Column:
    """Round to 6 places; adding 0.0 folds -0.0 into 0.0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6) + F.lit(0.0)


def passage_index(spark: SparkSession, sf_dir: str) -> PassageIndex:
    """The persisted index of the fixture's passages (built once per session)."""
    version = table_version(spark, table_path(sf_dir, "documents"))
    return index_for(spark, f"documents@{sf_dir}@{version}", tables.passages(spark, sf_dir))


# Derived, durable inputs shared by the registered queries of one session:
# in the reference the candidate pairs are an input file, so the candidate
# set (and its labels) is materialised once per query table, like the index.
_SHARED: dict[tuple, object] = {}
_SOURCES = ("documents", "benchmark", "labels", "embeddings")


def _version(spark: SparkSession, sf_dir: str) -> tuple:
    """Changes when a source table is rewritten, so nothing stale is shared."""
    return tuple(table_version(spark, table_path(sf_dir, t)) for t in _SOURCES)


def _shared(spark: SparkSession, key: tuple, make):
    """``make()`` once per session, ``key`` (name, sf_dir) and version of the sources."""
    k = (spark.sparkContext.applicationId, *key, _version(spark, key[1]))
    if k not in _SHARED:
        _SHARED[k] = make()
    return _SHARED[k]


def retrieval(spark: SparkSession, sf_dir: str) -> Retrieval:
    return _shared(spark, ("retrieval", sf_dir),
                   lambda: Retrieval(passage_index(spark, sf_dir), tables.queries(spark, sf_dir)))


# ----------------------------------------------------------------- analyzers
def q_tokenize_index(spark, sf_dir):
    p = tables.passages(spark, sf_dir).select("pid", T.index_tokens("passage").alias("t"))
    return p.select("pid", F.size("t").cast("long").alias("n_tokens"), T.joined(F.col("t")).alias("tokens"))


def q_tokenize_ws(spark, sf_dir):
    q = tables.queries(spark, sf_dir).select("qid", T.ws_tokens("query").alias("t"))
    return q.select("qid", F.size("t").cast("long").alias("n_tokens"), T.joined(F.col("t")).alias("tokens"))


def q_wordlist_html(spark, sf_dir):
    p = tables.pages(spark, sf_dir).select("page_id", T.word_list("html").alias("w"))
    return p.select("page_id", F.size("w").cast("long").alias("n_words"), T.joined(F.col("w")).alias("words"))


def q_wordlist_stopwords(spark, sf_dir):
    p = tables.pages(spark, sf_dir).select("page_id", T.word_list("html", remove_stopwords=True).alias("w"))
    return p.select("page_id", F.size("w").cast("long").alias("n_words"), T.joined(F.col("w")).alias("words"))


def q_sentences(spark, sf_dir):
    d = tables.passages(spark, sf_dir).select("pid", T.raw_sentences("passage").alias("s"))
    rows = d.select("pid", F.posexplode("s").alias("sent_no", "sentence"))
    rows = rows.select("pid", F.col("sent_no").cast("long").alias("sent_no"),
                       T.word_list("sentence").alias("w"))
    return rows.select("pid", "sent_no", F.size("w").cast("long").alias("n_words"),
                       T.joined(F.col("w")).alias("words"))


def q_abbreviation_scores(spark, sf_dir):
    """How often each word type of the corpus ends in a period, and its score as an abbreviation."""
    rows = B.abbreviation_scores(B.type_counts(tables.passages(spark, sf_dir), "passage"))
    return rows.select("type", "with_period", "without", r6("llr").alias("llr"), r6("score").alias("score"))


def q_learned_sentences(spark, sf_dir):
    """Sentences by boundaries learned from the corpus, counted per passage."""
    p = tables.passages(spark, sf_dir)
    known = _shared(spark, ("abbreviations", sf_dir), lambda: durable(B.abbreviations(p, "passage")))
    rows = B.sentences(p, "pid", "passage", known)
    return rows.select("pid", F.size("sentences").cast("long").alias("n_sentences"), F.md5(F.array_join("sentences", "\n")).alias("md5"))


# --------------------------------------------------------------------- index
def q_passage_dedup(spark, sf_dir):
    return I.dedup_by_text(tables.passages(spark, sf_dir)).select(
        "pid", F.col("word_count").cast("long").alias("word_count"), "n_copies")


def q_vocabulary(spark, sf_dir):
    v = I.vocabulary_from_counts(passage_index(spark, sf_dir).doc_freq.select("term", F.col("cf").alias("count")))
    return v.select("term", "count", r6("normalised_frequency").alias("normalised_frequency"), "rank")


def q_zipf(spark, sf_dir):
    idx = passage_index(spark, sf_dir)
    counts = idx.doc_freq.select("term", F.col("cf").alias("count"))
    z = I.zipf_from_counts(counts, idx.stats()["total_tokens"])
    return z.select("rank", "term", r6("normalised_frequency").alias("normalised_frequency"),
                    r6("zipf").alias("zipf"))


def q_inverted_index(spark, sf_dir):
    post = passage_index(spark, sf_dir).postings
    return post.select("term", "pid", "tf", F.col("word_count").cast("long").alias("word_count"))


def q_document_frequency(spark, sf_dir):
    return passage_index(spark, sf_dir).doc_freq.select(
        "term", "df", F.col("cf").cast("long").alias("cf"))


def q_corpus_stats(spark, sf_dir):
    s = I.corpus_stats_frame(tables.passages(spark, sf_dir))
    return s.select("n_passages", r6("avdl").alias("avdl"), "total_words", "n_nonempty",
                    "total_tokens", "vocabulary_size")


# ------------------------------------------------------------------- scoring
def q_tfidf_passage(spark, sf_dir):
    v = retrieval(spark, sf_dir).tfidf_passage_vectors()
    return v.select("pid", "term", r6("weight").alias("weight"))


def q_tfidf_query(spark, sf_dir):
    v = retrieval(spark, sf_dir).tfidf_query_vectors()
    return v.select("qid", "term", "k", r6("weight").alias("weight"))


def _scored(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf_dir):
        s = retrieval(spark, sf_dir).score(name)
        return s.select("qid", "pid", r6("score").alias("score"))
    run.__name__ = f"q_{name}"
    return run


def ranked_prefix(r: Retrieval, scorer: str, k: int = 100) -> DataFrame:
    """Reference ranking: first k candidates per query by ord, then by score."""
    cands = durable(prefix_within(r.candidate_pairs(), ["qid"], k))
    scored = r.with_candidates(cands).score(scorer)
    return top_k_within(scored, ["qid"], [score_key("score"), F.col("ord")], k)


def q_bm25_prefix100(spark, sf_dir):
    out = ranked_prefix(retrieval(spark, sf_dir), "bm25", 100)
    return out.select("qid", "pid", r6("score").alias("score"), "rank")


def q_bm25_top10(spark, sf_dir):
    out = bm25_top(retrieval(spark, sf_dir), 10)
    return out.select("qid", "pid", r6("score").alias("score"), "rank")


def q_run_union(spark, sf_dir):
    r = retrieval(spark, sf_dir)
    ranked = ranked_runs(all_scores(spark, sf_dir), r.group_bound())
    return ranked.select("algoname", "qid", "pid", r6("score").alias("score"), "rank")


def ranked_runs(scored: DataFrame, group_bound: int | None, window_rows: int = WINDOW_GROUP_ROWS) -> DataFrame:
    """(algoname, qid, pid, score, rank) of the five runs that stand side by side in ``scored``.

    The pairs move once, by query, and are ranked there run after run. Groups above ``window_rows``
    take the distributed sort, one run at a time; a run's shuffles are gone before the next one is sorted."""
    if group_bound is None or group_bound > window_rows:
        out = None
        for s in SCORERS:
            run = scored.select(F.lit(s).alias("algoname"), "qid", "pid", "ord", F.col(s).alias("score"))
            one = rank_by_score(run, ["algoname", "qid"], window_rows=window_rows, group_bound=group_bound, hidden=["ord"])
            out = one if out is None else out.unionByName(one)
            release_shuffles(scored.sparkSession)
        return out
    # the order of a run is that of the rounded scores, then ord
    keys = scored.withColumns({f"_k_{s}": F.round(s, 9) for s in SCORERS})
    rows = keys.withColumns({f"_r_{s}": F.row_number().over(Window.partitionBy("qid").orderBy(F.col(f"_k_{s}").desc(), F.col("ord"))).cast("long") for s in SCORERS})
    each = F.array(*[F.struct(F.lit(s).alias("algoname"), F.col(s).alias("score"), F.col(f"_r_{s}").alias("rank")) for s in SCORERS])
    return rows.select("qid", "pid", F.explode(each).alias("_s")).select("_s.algoname", "qid", "pid", "_s.score", "_s.rank")


def all_scores(spark, sf_dir):
    """The five scores of every candidate pair, materialised once per session."""
    return _shared(spark, ("scores", sf_dir), lambda: stored(retrieval(spark, sf_dir).all_scores(), "scores"))


# ---------------------------------------------------------------- evaluation
def label_sources(r: Retrieval, spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Relevant pairs (qid, pid) and passages of grade 1 (pid), materialised once per retrieval."""
    return _shared(spark, ("label-sources", sf_dir), lambda: (
        durable(contained_pairs(r.passages, r.queries)), durable(good_passages(tables.quality_labels(spark, sf_dir)))))


def labelled(r: Retrieval, spark: SparkSession, sf_dir: str, names: tuple[str, ...] = ()) -> DataFrame:
    """(qid, pid, ord, *scores by ``names``, relevancy, grade) of every candidate pair.

    Tasks that score whole passages label them in the same pass; labels that take
    joins over the pairs are materialised once per retrieval."""
    if r.by_passage():
        return r.passage_scores(list(names), *label_sources(r, spark, sf_dir))
    labels = _shared(spark, ("labels", sf_dir), lambda: durable(label_candidates(
        r.candidate_pairs(), r.passages, r.queries, tables.quality_labels(spark, sf_dir))))
    if not names:
        return labels
    scored = r.score(names[0]).withColumnRenamed("score", names[0]) if len(names) == 1 else all_scores(spark, sf_dir).select("qid", "pid", "ord", *names)
    return scored.join(labels, ["qid", "pid", "ord"])


def pair_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(qid, pid, ord, relevancy, grade) of every candidate pair, written once per session:
    learners read the pairs several times, each of which would score and label all passages again."""
    r = retrieval(spark, sf_dir)
    if not r.by_passage():
        return labelled(r, spark, sf_dir)

    def make():
        return stored(labelled(r, spark, sf_dir), "pair-labels")
    return _shared(spark, ("pair-labels", sf_dir), make)


def ranked_labelled(r: Retrieval, spark: SparkSession, sf_dir: str, scorer: str) -> DataFrame:
    """(qid, pid, ord, score, relevancy, grade, rank) over all candidates, durable."""
    run = labelled(r, spark, sf_dir, (scorer,)).withColumnRenamed(scorer, "score")
    if r.group_bound() > WINDOW_GROUP_ROWS:
        run = stored(run, "scored")  # the range sort reads its input twice
    return stored(E.rank_run(run, group_bound=r.group_bound()), "run")


def labelled_run(spark: SparkSession, sf_dir: str, scorer: str = "bm25") -> tuple[Retrieval, DataFrame]:
    r = retrieval(spark, sf_dir)
    return r, _shared(spark, (f"run-{scorer}", sf_dir), lambda: ranked_labelled(r, spark, sf_dir, scorer))


def q_bm25_labelled(spark, sf_dir):
    _, run = labelled_run(spark, sf_dir, "bm25")
    return run.select("qid", "pid", r6("score").alias("score"), "relevancy", "grade", "rank")


def q_average_precision(spark, sf_dir):
    r, run = labelled_run(spark, sf_dir, "bm25")
    ap = E.average_precision(run, "relevancy", r.group_bound())
    return ap.select("qid", r6("ave_precision").alias("ave_precision"))


def q_ndcg_global(spark, sf_dir):
    r, run = labelled_run(spark, sf_dir, "bm25")
    nd = E.ndcg(run, "grade", "global_max", r.group_bound())
    return nd.select("qid", r6("dcg").alias("dcg"), r6("ndcg").alias("ndcg"))


def q_ndcg_ideal(spark, sf_dir):
    r, run = labelled_run(spark, sf_dir, "bm25")
    nd = E.ndcg(run, "grade", "ideal", r.group_bound())
    return nd.select("qid", r6("dcg").alias("dcg"), r6("ndcg").alias("ndcg"))


def q_map_ndcg_summary(spark, sf_dir):
    r = retrieval(spark, sf_dir)
    out = E.wide_summary(labelled(r, spark, sf_dir, SCORERS), SCORERS, "algoname", "relevancy", "grade", r.group_bound())
    return out.select("algoname", r6("map").alias("map"), r6("mean_ndcg").alias("mean_ndcg"))


def q_run_file_rows(spark, sf_dir):
    top = bm25_top(retrieval(spark, sf_dir), 100)
    # written as a run file and read back
    path = scratch(spark, "run6")
    files.write_run6(top, path, "BM25", 100)
    return files.read_run6(spark, path).select("qid", "A", "pid", "rank", r6("score").alias("score"), "algoname")


def scratch(spark, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:8]}")


# ------------------------------------------------------------- file to run
def pair_file(spark, sf_dir, labelled_file: bool = False) -> str:
    """The fixture as a candidate file: every passage under two queries, those with the
    numbers pid and pid + 1 modulo the number of queries, so every pid repeats."""
    numbered = global_rank(tables.queries(spark, sf_dir), ["qid"], "no").withColumn("no", F.col("no") - 1)
    n = max(numbered.count(), 1)
    p = tables.passages(spark, sf_dir).select("pid", "passage", F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
    pairs = p.withColumn("no", (F.col("pid") + F.col("k")) % n).join(numbered, "no")
    if labelled_file:
        hit = F.contains(F.lower(F.coalesce("passage", F.lit(""))), F.lower("query"))
        rows = pairs.select("qid", "pid", F.col("query").alias("queries"), "passage", F.when(hit, 1.0).otherwise(0.0).alias("relevancy"))
    else:
        rows = pairs.select("qid", "pid", "query", "passage")
    path = scratch(spark, "pairs")
    files.write_tsv(rows, path, header=labelled_file)
    return path


def q_passage_dedup_pid(spark, sf_dir):
    """Candidate TSV read back; one passage per pid."""
    rows = files.read_candidates_tsv(spark, pair_file(spark, sf_dir))
    return I.passage_table(rows).select("pid", F.col("word_count").cast("long").alias("word_count"),
                                        F.md5(F.coalesce("passage", F.lit(""))).alias("passage_md5"))


def q_labelled_tsv(spark, sf_dir):
    """Headed TSV with literal quotes, read back."""
    rows = files.read_labelled_tsv(spark, pair_file(spark, sf_dir, labelled_file=True))
    return rows.select("qid", "pid", F.md5(F.coalesce("query", F.lit(""))).alias("query_md5"),
                       F.md5(F.coalesce("passage", F.lit(""))).alias("passage_md5"), "relevancy")


def q_tsv_bm25_run(spark, sf_dir):
    """Candidate and query TSV in, run file out: read, de-duplicate, index, score, write, read back."""
    rows = files.read_candidates_tsv(spark, pair_file(spark, sf_dir))
    path = scratch(spark, "queries")
    files.write_tsv(tables.queries(spark, sf_dir), path)
    index = PassageIndex.build(rows.select("pid", "passage", "ord"), scratch(spark, "tsv-index"))
    r = Retrieval(index, files.read_queries_tsv(spark, path), rows.select("qid", "pid", "ord"))
    out = scratch(spark, "run3")
    files.write_run3(r.bm25(), out)
    r.close()
    return files.read_run3(spark, out).select("qid", "pid", r6("score").alias("score"))


def q_file_prefix(spark, sf_dir):
    """The first 400 rows of a TSV of all passages in the order of their ids, later files unread."""
    path = scratch(spark, "prefix")
    rows = tables.passages(spark, sf_dir).select(F.col("pid").alias("qid"), "passage").orderBy("qid")
    files.write_tsv(rows, path)
    ordered = lambda s, names: files.with_file_order(files.read_queries_tsv(s, names))
    out = files.read_prefix(spark, ordered, path, 400)
    return out.select(F.col("qid").alias("pid"), F.md5(F.coalesce("query", F.lit(""))).alias("passage_md5"))


def q_corpus_terms(spark, sf_dir):
    """Passages as a text file, one line each per line, read back and counted."""
    path = scratch(spark, "corpus")
    tables.passages(spark, sf_dir).select(F.explode(F.split(F.coalesce("passage", F.lit("")), "[\r\n]+")).alias("value")).write.text(path)
    lines = files.read_text_corpus(spark, path).select(F.lit(0).alias("pid"), F.col("value").alias("passage"))
    return I.index_token_rows(lines).groupBy("term").agg(F.count(F.lit(1)).alias("count"))


def q_matrix_roundtrip(spark, sf_dir):
    """Feature matrix written as text files and read back in the same row order."""
    path = scratch(spark, "matrix")
    rows = tables.vectors(spark, sf_dir).select(F.col("vec_id").alias("ord"), F.transform("embedding", lambda x: x.cast("double")).alias("features"))
    files.write_matrix(rows, path)
    back = global_rank(files.read_dense_matrix(spark, path), [F.col("ord")], "row")
    back = back.select("row", F.posexplode("features").alias("dim", "value"))
    return back.select("row", F.col("dim").cast("long").alias("dim"), r6("value").alias("value"))


def q_pairwise_gradients(spark, sf_dir):
    """Gradient and hessian of the pairwise loss at the BM25 scores."""
    _, run = labelled_run(spark, sf_dir, "bm25")
    g = PW.pairwise_gradients(run.select("qid", "pid", "relevancy", "score"), "relevancy")
    return g.select("qid", "pid", r6("gradient").alias("gradient"), r6("hessian").alias("hessian"))


def q_label_histogram(spark, sf_dir):
    r = retrieval(spark, sf_dir)
    return labelled(r, spark, sf_dir).groupBy("relevancy").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ learners
# Fixed values of the fixture: logistic weights w_i = ((7 i) mod 11 - 5) / 10, b = 0.05.
def fixture_weights(dim: int = 64) -> list[float]:
    return [((i * 7) % 11 - 5) / 10 for i in range(dim)]


FIXTURE_BIAS = 0.05


def embedding_rows(spark, sf_dir):
    """(vec_id, qid, features array<double>, label 0-9, y binary) from ``embeddings``; qid = vec_id % 25."""
    v = tables.vectors(spark, sf_dir)
    return v.select("vec_id", (F.col("vec_id") % 25).alias("qid"),
                    F.transform("embedding", lambda x: x.cast("double")).alias("features"),
                    F.col("label").cast("long").alias("label"),
                    F.when(F.col("label") >= 5, 1.0).otherwise(0.0).alias("y"))


def q_avg_word_vectors(spark, sf_dir):
    r = retrieval(spark, sf_dir)
    counts = r.index.doc_freq.select("term", F.col("cf").alias("count"))
    vectors = X.fixture_word_vectors(counts, tables.vectors(spark, sf_dir))
    qv = X.average_vectors(r.queries, "qid", "query", vectors, 64, remove_stopwords=False)
    pv = X.average_vectors(r.passages, "pid", "passage", vectors, 64, remove_stopwords=True)
    both = qv.select(F.lit("q").alias("kind"), F.col("qid").alias("id"), "vector").unionByName(
        pv.select(F.lit("p").alias("kind"), F.col("pid").alias("id"), "vector"))
    rows = both.select("kind", "id", F.posexplode("vector").alias("dim", "value"))
    return rows.select("kind", "id", F.col("dim").cast("long").alias("dim"), r6("value").alias("value"))


def q_libsvm_roundtrip(spark, sf_dir):
    rows = embedding_rows(spark, sf_dir)
    path = scratch(spark, "libsvm")
    files.write_ranking_libsvm(rows.withColumn("ord", F.col("vec_id")), path)
    parsed = files.read_ranking_libsvm(spark, path)
    out = parsed.select("qid", "label", F.posexplode("features").alias("dim", "value"))
    return out.select("qid", "label", F.col("dim").cast("long").alias("dim"), r6("value").alias("value"))


def q_logistic_step(spark, sf_dir):
    """Two gradient-descent iterations from zero (lr 0.1) on the embeddings, y = label >= 5."""
    m = L.fit(embedding_rows(spark, sf_dir), 0.1, 2, "features", "y")
    params = [(f"w{i}", v) for i, v in enumerate(m.w)] + [("b", m.b)] + \
        [(f"cost{i}", c) for i, c in enumerate(m.costs)]
    # The fitted model is a handful of numbers; return it as a frame.
    return spark.createDataFrame(params, "param string, value double").select("param", r6("value").alias("value"))


def q_logistic_predict(spark, sf_dir):
    model = L.LogisticModel(fixture_weights(64), FIXTURE_BIAS, [], 0.0)
    rows = embedding_rows(spark, sf_dir)
    return rows.select("vec_id", r6(model.margin()).alias("z"), r6(model.probability()).alias("probability"),
                       model.predict().alias("prediction"))


# Passes of the Word2Vec models, rates and iterations of the sweep.
WORD2VEC_PASSES = 1
RATES = [10.0, 1.0, 0.5, 0.1, 0.01]
RANK_RATE = 0.1
ITERATIONS = 100


def text_means(spark, sf_dir):
    """Mean vectors of all queries and passages under the two Word2Vec models, once per session."""
    return _shared(spark, ("means", sf_dir), lambda: LR.text_means(
        tables.queries(spark, sf_dir), one_per_pid(tables.passages(spark, sf_dir)), max_iter=WORD2VEC_PASSES))


def factored(spark, sf_dir) -> tuple[FX.FactoredPairs, FX.FactoredPairs]:
    """Training and held-out pairs with the 600-dimensional features in factored form."""
    def make():
        qv, pv = text_means(spark, sf_dir)
        train, held = LR.split_queries(pair_labels(spark, sf_dir).select("qid", "pid", "ord", "relevancy"))
        return FX.FactoredPairs.build(train, qv, pv), FX.FactoredPairs.build(held, qv, pv)
    return _shared(spark, ("factored", sf_dir), make)


def sweep(spark, sf_dir) -> list[L.LogisticModel]:
    """One model a rate, all fitted in the same passes over the training pairs."""
    return _shared(spark, ("sweep", sf_dir), lambda: FX.fit_many(factored(spark, sf_dir)[0], RATES, ITERATIONS))


def q_lr_sweep(spark, sf_dir):
    """Costs of five learning rates on the training queries' pairs, 100 iterations each."""
    return L.cost_trace(spark, sweep(spark, sf_dir))


def fixture_means(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(qid, vector) and (pid, vector): averaged fixture vectors (64 dimensions) of every text, once per session."""
    def make():
        r = retrieval(spark, sf_dir)
        vectors = durable(X.fixture_word_vectors(r.index.doc_freq.select("term", F.col("cf").alias("count")), tables.vectors(spark, sf_dir)))
        means = (durable(X.average_vectors(r.queries, "qid", "query", vectors, LR.FIXTURE_DIM)),
                 durable(X.average_vectors(r.passages, "pid", "passage", vectors, LR.FIXTURE_DIM, remove_stopwords=True)))
        release_shuffles(spark)  # the vectors that were sent as well
        return means
    return _shared(spark, ("fixture-means", sf_dir), make)


def fixture_factored(spark, sf_dir) -> FX.FactoredPairs:
    """All labelled pairs with the averaged fixture vectors (64 + 64 dimensions), in factored form."""
    return _shared(spark, ("fixture-factored", sf_dir), lambda: FX.FactoredPairs.build(
        labelled(retrieval(spark, sf_dir), spark, sf_dir), *fixture_means(spark, sf_dir)))


def fixture_split(spark, sf_dir) -> tuple[FX.FactoredPairs, FX.FactoredPairs]:
    """``fixture_factored`` of the training and of the held-out queries."""
    return _shared(spark, ("fixture-split", sf_dir), lambda: tuple(
        FX.FactoredPairs.build(pairs, *fixture_means(spark, sf_dir)) for pairs in LR.split_queries(pair_labels(spark, sf_dir))))


def q_factorised_descent(spark, sf_dir):
    """Ten iterations from zero (rates 0.5 and 5) over all labelled pairs: weights, bias and costs."""
    rows = []
    for m in FX.fit_many(fixture_factored(spark, sf_dir), [0.5, 5.0], 10):
        rows += [(m.learning_rate, f"w{i}", v) for i, v in enumerate(m.w)] + [(m.learning_rate, "b", m.b)]
        rows += [(m.learning_rate, f"cost{i}", c) for i, c in enumerate(m.costs)]
    return spark.createDataFrame(rows, "rate double, param string, value double").select("rate", "param", r6("value").alias("value"))


def q_factorised_predict(spark, sf_dir):
    """Probability of every labelled pair under fixed weights, from one margin a text."""
    model = L.LogisticModel(fixture_weights(2 * LR.FIXTURE_DIM), FIXTURE_BIAS, [], 0.0)
    out = FX.logistic_scores(fixture_factored(spark, sf_dir), model, hard=False)
    return out.select("qid", "pid", r6("score").alias("probability"), F.when(F.col("score") > 0.5, 1.0).otherwise(0.0).alias("prediction"))


def feature_table(spark, sf_dir):
    """Candidate pair features and labels, materialised once per session."""
    r = retrieval(spark, sf_dir)
    return _shared(spark, ("features", sf_dir), lambda: LR.candidate_feature_table(
        r, tables.vectors(spark, sf_dir), labelled(r, spark, sf_dir)))


def _logistic(spark, sf_dir):
    model = next(m for m in sweep(spark, sf_dir) if m.learning_rate == RANK_RATE)
    return FX.logistic_scores(factored(spark, sf_dir)[1], model)


def _perceptron(spark, sf_dir):
    train, held = factored(spark, sf_dir)
    return LR.MlpRanker.fit_factored(train).score_pairs(held)


def _boosted(spark, sf_dir):
    # repeated or null query ids, and query sides above the broadcast bound, take whole rows
    whole = not retrieval(spark, sf_dir).by_passage()
    train, held = LR.split_queries(feature_table(spark, sf_dir)) if whole else fixture_split(spark, sf_dir)
    return PW.boosted_fit(train).score(held)


#: name -> f(spark, sf_dir) -> scored held-out pairs
RANKERS = {"LR": _logistic, "LM": _boosted, "NN": _perceptron}


def learned_run(spark, sf_dir, name: str):
    """Held-out queries scored by a ranker fitted on the relevancy of the other queries."""
    def make():
        scored = RANKERS[name](spark, sf_dir).select("qid", "pid", "ord", "score")
        return durable(scored.join(pair_labels(spark, sf_dir), ["qid", "pid", "ord"])
                       .select("qid", "pid", "ord", "score", "relevancy", "grade"))
    return _shared(spark, (f"learned-{name}", sf_dir), make)


def _learned_rank(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf_dir):
        top = LR.ranked_run(learned_run(spark, sf_dir, name), depth=100)
        return E.run_rows(top, name, 100).select("qid", "A", "pid", "rank", r6("score").alias("score"), "algoname")
    return run


def q_learned_summary(spark, sf_dir):
    """MAP, mean NDCG and accuracy of every learned ranker on the held-out
    queries; ``best`` marks the ranker of the highest MAP."""
    bound = retrieval(spark, sf_dir).group_bound()
    runs = None
    for name in RANKERS:
        run = learned_run(spark, sf_dir, name).withColumn("algoname", F.lit(name))
        runs = run if runs is None else runs.unionByName(run)
    out = E.scored_summary(runs, "algoname", "relevancy", "grade", bound)
    hit = F.when((F.col("score") > 0.5) == (F.col("relevancy") == 1.0), 1.0).otherwise(0.0)
    out = durable(out.join(runs.groupBy("algoname").agg(F.avg(hit).alias("accuracy")), "algoname"))
    best = E.best_by_map(out)
    return out.select("algoname", r6("map").alias("map"), r6("mean_ndcg").alias("mean_ndcg"), r6("accuracy").alias("accuracy"),
                      (F.col("algoname") == best).alias("best"))


def q_word2vec_features(spark, sf_dir):
    """The mean vector (300 dimensions) of every text under its Word2Vec model."""
    qv, pv = text_means(spark, sf_dir)
    return qv.select(F.lit("q").alias("kind"), F.col("qid").alias("id"), "vector").unionByName(
        pv.select(F.lit("p").alias("kind"), F.col("pid").alias("id"), "vector"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "tokenize_index": q_tokenize_index,
    "tokenize_ws": q_tokenize_ws,
    "wordlist_html": q_wordlist_html,
    "wordlist_stopwords": q_wordlist_stopwords,
    "sentences": q_sentences,
    "abbreviation_scores": q_abbreviation_scores,
    "learned_sentences": q_learned_sentences,
    "file_prefix": q_file_prefix,
    "passage_dedup": q_passage_dedup,
    "vocabulary": q_vocabulary,
    "zipf": q_zipf,
    "inverted_index": q_inverted_index,
    "document_frequency": q_document_frequency,
    "corpus_stats": q_corpus_stats,
    "tfidf_passage": q_tfidf_passage,
    "tfidf_query": q_tfidf_query,
    "tfidf_cosine": _scored("tfidf_cosine"),
    "bm25": _scored("bm25"),
    "bm25_prefix100": q_bm25_prefix100,
    "bm25_top10": q_bm25_top10,
    "laplace": _scored("laplace"),
    "lidstone": _scored("lidstone"),
    "dirichlet": _scored("dirichlet"),
    "run_union": q_run_union,
    "bm25_labelled": q_bm25_labelled,
    "average_precision": q_average_precision,
    "ndcg_global": q_ndcg_global,
    "ndcg_ideal": q_ndcg_ideal,
    "map_ndcg_summary": q_map_ndcg_summary,
    "run_file_rows": q_run_file_rows,
    "label_histogram": q_label_histogram,
    "avg_word_vectors": q_avg_word_vectors,
    "libsvm_roundtrip": q_libsvm_roundtrip,
    "logistic_step": q_logistic_step,
    "logistic_predict": q_logistic_predict,
    "factorised_descent": q_factorised_descent,
    "factorised_predict": q_factorised_predict,
    "lr_sweep": q_lr_sweep,
    "logistic_fit": _learned_rank("LR"),
    "mlp_rank": _learned_rank("NN"),
    "boosted_rank": _learned_rank("LM"),
    "learned_summary": q_learned_summary,
    "pairwise_gradients": q_pairwise_gradients,
    "passage_dedup_pid": q_passage_dedup_pid,
    "labelled_tsv": q_labelled_tsv,
    "tsv_bm25_run": q_tsv_bm25_run,
    "corpus_terms": q_corpus_terms,
    "matrix_roundtrip": q_matrix_roundtrip,
    "word2vec_features": q_word2vec_features,
}
