import pytest

from quarry.operators.scoring import Retrieval, ScoringParams
from quarry.sources.passage_index import PassageIndex


def flat(rows):
    return [x for r in sorted(tuple(r) for r in rows) for x in r]


# Hand goldens (FIXTURES.md section 4): N=4, avdl=3.25, V=10, PL=13.
EXPECTED = {
    "tfidf_cosine": {1: 1.208137, 2: 0.123091, 3: 0.0, 4: 0.0},
    "bm25": {1: 3.465003, 2: 0.0, 3: 0.0, 4: 0.0},
    "laplace": {1: -8.180356, 2: -9.56665, 3: -9.56665, 4: -10.259797},
    "lidstone": {1: -10.356507, 2: -13.289181, 3: -13.289181, 4: -14.755518},
    "dirichlet": {1: -6.592067, 2: -7.05429, 3: -7.176508, 4: -7.176508},
}


def test_corpus_stats(golden):
    s = golden.stats()
    assert s["n_passages"] == 4
    assert s["avdl"] == pytest.approx(3.25)
    assert s["vocabulary_size"] == 10
    assert s["total_words"] == 13


@pytest.mark.parametrize("scorer", sorted(EXPECTED))
def test_scorer_goldens(golden, scorer):
    got = {r.pid: r.score for r in golden.score(scorer).collect()}
    assert set(got) == {1, 2, 3, 4}
    for pid, want in EXPECTED[scorer].items():
        assert got[pid] == pytest.approx(want, abs=1e-6), (scorer, pid)


def test_derived_candidates(golden):
    # 'red' and 'fox' are index terms; 'day' is not ('d', 'y' are).
    r = golden.with_candidates(None)
    r.candidates = None
    pids = sorted(row.pid for row in r.derived_candidates().collect())
    assert pids == [1, 2]


def test_bm25_zero_without_shared_raw_term(golden):
    scores = {r.pid: r.score for r in golden.bm25().collect()}
    assert scores[3] == 0.0 and scores[4] == 0.0


def test_all_scores_equal_single_scorers(golden):
    rows = {r.pid: r for r in golden.all_scores().collect()}
    for scorer, expected in EXPECTED.items():
        for pid, want in expected.items():
            assert rows[pid][scorer] == pytest.approx(want, abs=1e-6), (scorer, pid)


def test_first_wins_dedup(spark):
    from quarry.operators.index import dedup_by_text
    from quarry.operators.ranking import first_wins

    df = spark.createDataFrame([(5, "same text", 5), (2, "same text", 2), (9, "other", 9)],
                               "pid long, passage string, ord long")
    kept = sorted((r.pid, r.n_copies) for r in dedup_by_text(df).collect())
    assert kept == [(2, 2), (9, 1)]
    keyed = first_wins(df.withColumnRenamed("passage", "k"), ["k"], "ord").collect()
    assert sorted((r.k, r.pid) for r in keyed) == [("other", 9), ("same text", 2)]


def test_repeated_passages_count_once(spark, golden, tmp_path):
    """A candidate file holds a passage under several queries; statistics must not double."""
    rows = [(1, "the red fox", 1), (2, "Red red dog.", 2), (3, "blue sky  day", 3), (4, "the old crow", 4),
            (1, "the red fox", 5), (1, "another text", 6), (3, "blue sky  day", 7)]
    idx = PassageIndex.build(spark.createDataFrame(rows, "pid long, passage string, ord long"), str(tmp_path / "idx"))
    assert idx.stats() == golden.index.stats()
    cands = spark.createDataFrame([(1, p, p) for p in (1, 2, 3, 4)], "qid long, pid long, ord long")
    got = flat(Retrieval(idx, golden.queries, cands).all_scores().collect())
    assert got == pytest.approx(flat(golden.all_scores().collect()))
    assert not (tmp_path / "idx" / "tokens").exists()


def test_too_small_n_is_refused(golden):
    r = Retrieval(golden.index, golden.queries, golden.candidates, ScoringParams(n_passages=1))
    with pytest.raises(ValueError, match="document frequency"):
        r.bm25()


def test_shuffled_and_broadcast_query_side_agree(golden):
    r = Retrieval(golden.index, golden.queries, golden.candidates, ScoringParams(broadcast_rows=0))
    assert flat(r.bm25().collect()) == pytest.approx(flat(golden.bm25().collect()))


def test_whole_passages_score_like_the_shuffled_shape(spark, tmp_path):
    """Derived candidates scored passage by passage: same pairs, scores and labels as joins
    over the pairs, and no exchange; terms shared by several queries, an unknown one, empty texts."""
    from quarry.sources.labelled import contained_pairs, good_passages, label_candidates

    rows = [(1, "the red fox", 1), (2, "Red red dog.", 2), (3, "blue sky  day", 3), (4, "the old red crow fox fox", 4), (5, "", 5), (6, None, 6)]
    passages = spark.createDataFrame(rows, "pid long, passage string, ord long")
    queries = spark.createDataFrame([(1, "red fox fox day"), (2, "the red"), (3, "unknown"), (4, ""), (5, None), (6, "old red")], "qid long, query string")
    quality = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (4, 1, 1), (2, 0, 0)], "pid long, quality int, toxic int")
    idx = PassageIndex.build(passages, str(tmp_path / "idx"))
    whole, pairs = Retrieval(idx, queries), Retrieval(idx, queries, params=ScoringParams(broadcast_rows=0))
    assert whole.by_passage() and not pairs.by_passage()
    assert flat(whole.all_scores().collect()) == pytest.approx(flat(pairs.all_scores().collect()))
    for scorer in EXPECTED:
        assert flat(whole.score(scorer).collect()) == pytest.approx(flat(pairs.score(scorer).collect())), scorer
    want = label_candidates(pairs.candidate_pairs(), passages, queries, quality).collect()
    got = whole.passage_scores([], contained_pairs(passages, queries), good_passages(quality)).collect()
    assert flat(got) == flat(want)
    assert "Exchange" not in whole.score("bm25")._jdf.queryExecution().toString()
    # norms and labels above the broadcast bound: passages move, cut to their query terms
    moved = Retrieval(idx, queries)
    assert moved.by_passage()
    moved.params = ScoringParams(broadcast_rows=1)
    assert flat(moved.all_scores().collect()) == pytest.approx(flat(pairs.all_scores().collect()))
    assert flat(moved.passage_scores([], contained_pairs(passages, queries), good_passages(quality)).collect()) == flat(want)
    assert moved.score("tfidf_cosine")._jdf.queryExecution().toString().count("MapInArrow") > whole.score("tfidf_cosine")._jdf.queryExecution().toString().count("MapInArrow")


def test_index_tables_are_made_when_asked_for(spark, tmp_path):
    rows = [(1, "the red fox", 1), (2, "Red red dog.", 2)]
    idx = PassageIndex.build(spark.createDataFrame(rows, "pid long, passage string, ord long"), str(tmp_path / "idx"))
    made = lambda: {p.name for p in (tmp_path / "idx").iterdir()}
    assert made() == {"forward"}
    df = {r.term: (r.df, r.cf) for r in idx.doc_freq.collect()}
    assert df["red"] == (2, 3) and made() == {"forward", "doc_freq"}
    some = [sorted(map(tuple, idx.with_df(idx.postings, bound).collect())) for bound in (100, 2)]
    assert some[0] == some[1] and len(some[0]) == len(idx.postings.collect())
