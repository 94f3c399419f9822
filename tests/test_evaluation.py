import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import evaluation as E
from quarry.operators.ranking import rank_by_score, rank_within, score_key


@pytest.fixture(scope="module")
def ranked(spark):
    # Query 1 ranked labels [1,0,1]; query 2 [0,1]; query 3 [0,0] (FIXTURES.md section 4).
    rows = [(1, 1, 3.0, 1.0), (1, 2, 2.0, 0.0), (1, 3, 1.0, 1.0),
            (2, 4, 2.0, 0.0), (2, 5, 1.0, 1.0),
            (3, 6, 2.0, 0.0), (3, 7, 1.0, 0.0)]
    run = spark.createDataFrame(rows, "qid long, pid long, score double, relevancy double") \
        .withColumn("ord", F.col("pid"))
    return E.rank_run(run)


def test_average_precision(ranked):
    ap = {r.qid: r.ave_precision for r in E.average_precision(ranked).collect()}
    assert ap[1] == pytest.approx(0.833333, abs=1e-6)
    assert ap[2] == pytest.approx(0.5)
    assert ap[3] == 0.0


def test_ndcg_global_and_ideal(ranked):
    g = {r.qid: (r.dcg, r.ndcg) for r in E.ndcg(ranked, "relevancy", "global_max").collect()}
    assert g[1][0] == pytest.approx(1.5)
    assert g[2][0] == pytest.approx(0.630930, abs=1e-6)
    assert g[1][1] == pytest.approx(1.0) and g[2][1] == pytest.approx(0.420620, abs=1e-6) and g[3][1] == 0.0
    i = {r.qid: r.ndcg for r in E.ndcg(ranked, "relevancy", "ideal").collect()}
    assert i[1] == pytest.approx(0.919721, abs=1e-6)
    assert i[2] == pytest.approx(0.630930, abs=1e-6)
    assert i[3] == 0.0


def test_summary_means(ranked):
    row = E.summary(ranked, "x").first()
    assert row["map"] == pytest.approx(0.444444, abs=1e-6)
    assert row["mean_ndcg"] == pytest.approx(0.473540, abs=1e-6)


def test_rank_paths_agree(spark):
    """The window path and the distributed range-sort path give identical ranks."""
    rows = [(q % 3, i, float((i * 37) % 11), i) for q in range(30) for i in range(q * 50, q * 50 + 40)]
    df = spark.createDataFrame(rows, "qid long, pid long, score double, ord long").repartition(5)
    order = [score_key("score"), F.col("ord")]
    a = {(r.qid, r.pid): r.rank for r in rank_within(df, ["qid"], order).collect()}
    b = {(r.qid, r.pid): r.rank for r in rank_within(df, ["qid"], order, window_rows=0).collect()}
    assert a == b
    # ranks are 1..n per query
    for q in range(3):
        ranks = sorted(v for (qq, _), v in a.items() if qq == q)
        assert ranks == list(range(1, len(ranks) + 1))


def test_accuracy_and_choice(spark, ranked):
    scored = spark.createDataFrame([(0.9, 1.0), (0.2, 0.0), (0.6, 0.0), (0.5, 1.0)], "score double, label double")
    assert E.accuracy(scored) == 0.5
    sums = E.summary(ranked, "A").unionByName(E.summary(ranked.withColumn("relevancy", F.lit(0.0)), "B"))
    assert E.best_by_map(sums) == "A"


def test_rank_paths_agree_on_null_groups(spark):
    from quarry.operators.ranking import rank_within
    rows = [(None, 3), (None, 1), (None, 2), (1, 5), (1, 4), (2, 9)]
    df = spark.createDataFrame(rows, "g long, x long")
    one, other = (sorted(rank_within(df, ["g"], ["x"], window_rows=w).collect(), key=str) for w in (100, 0))
    assert one == other and len(one) == 6


def test_scored_summary_matches_single_runs(spark):
    import random
    rnd = random.Random(4)
    rows = [(a, q, p, p, rnd.random(), float(rnd.random() < 0.2), float(rnd.randrange(3))) for a in "xy" for q in range(5) for p in range(20)]
    df = spark.createDataFrame(rows, "algoname string, qid long, pid long, ord long, score double, relevancy double, grade double")
    want = {}
    for a in "xy":
        r = E.summary(E.rank_run(df.where(F.col("algoname") == a)), a, "relevancy", "grade").first()
        want[a] = (r["map"], r.mean_ndcg)
    for bound in (100, None):  # one window, and the distributed sort
        got = {r.algoname: (r["map"], r.mean_ndcg) for r in E.scored_summary(df, group_bound=bound, window_rows=100 if bound else 0).collect()}
        assert all(got[a] == pytest.approx(want[a]) for a in want)


def test_wide_summary_matches_runs_ranked_one_by_one(spark):
    """Runs side by side, ranked after one exchange, or one at a time above the window bound."""
    rng = random.Random(8)
    rows = [(q, i, float(rng.randrange(9)), rng.random(), float(rel := rng.random() < 0.2), 2.0 * rel if rel else float(rng.random() < 0.3))
            for q in range(5) for i in range(30)]
    wide = spark.createDataFrame(rows, "qid long, ord long, a double, b double, relevancy double, grade double")
    each = None
    for s in "ab":
        one = wide.selectExpr(f"'{s}' as algoname", "qid", "ord", f"{s} as score", "relevancy", "grade")
        each = one if each is None else each.unionByName(one)
    want = sorted(map(tuple, E.scored_summary(each, group_bound=100).collect()))
    narrow = E.wide_summary(wide, ["a", "b"], group_bound=100)
    assert str(narrow._jdf.queryExecution().sparkPlan()).count("Window") == 2 * str(E.scored_summary(each, group_bound=100)._jdf.queryExecution().sparkPlan()).count("Window")
    for got in (narrow, E.wide_summary(wide, ["a", "b"], group_bound=100, window_rows=10)):
        assert [x for r in sorted(map(tuple, got.collect())) for x in r] == pytest.approx([x for r in want for x in r])


def test_distributed_ranks_are_stored_as_columns_and_sort_a_rounded_score_once(spark):
    """Hot groups: the order is written compressed, by a key that no comparison rounds anew."""
    rows = [(q, i, i, s) for q in (1, None) for i, s in enumerate([0.5, 0.5 + 1e-12, None, float("nan"), -1.0, 0.7])]
    df = spark.createDataFrame(rows, "qid long, pid long, ord long, score double")
    small, large = (rank_by_score(df, ["qid"], window_rows=w) for w in (100, 0))
    assert large.columns == small.columns == [*df.columns, "rank"] and large.inputFiles()
    one, other = ({(r.qid, r.pid): r["rank"] for r in x.collect()} for x in (small, large))
    assert one == other and [one[1, p] for p in (3, 5, 0, 1, 4, 2)] == [1, 2, 3, 4, 5, 6]


def test_large_runs_leave_one_order_at_a_time(spark, monkeypatch):
    """Above the bound a summary writes the ranks and labels of one run at a time and deletes them."""
    from quarry.plans import execution as EX

    rows = [(q, p, p, 1.0 / (1 + (p * 7 + q) % 13), float(p % 5), float(p == q), float(p % 3)) for q in range(6) for p in range(40)]
    wide = spark.createDataFrame(rows, "qid long, pid long, ord long, a double, b double, relevancy double, grade double")
    made, gone, real = [], [], EX.kept
    watched = lambda df, name: made.append((name, df.columns, sum(gone))) or real(df, name)
    monkeypatch.setattr(E, "kept", watched)
    monkeypatch.setattr("quarry.operators.ranking.kept", watched)
    monkeypatch.setattr(E, "delete_folder", lambda s, path: gone.append(1) or EX.delete_folder(s, path))
    got = E.wide_summary(wide, ["a", "b"], group_bound=40, window_rows=10).collect()
    monkeypatch.undo()
    assert sorted((r.algoname, round(r["map"], 12), round(r.mean_ndcg, 12)) for r in got) == sorted(
        (r.algoname, round(r["map"], 12), round(r.mean_ndcg, 12)) for r in E.wide_summary(wide, ["a", "b"], group_bound=40).collect())
    ranked = [(columns, before) for name, columns, before in made if name == "ranked"]
    assert [before for _, before in ranked] == [0, 1] and len(gone) == len(made)  # the first run's order is gone before the second
    assert all(not {"score", "ord", "_key"} & set(columns) for columns, _ in ranked)


def test_union_of_runs_is_ranked_run_by_run(spark):
    from quarry.operators.scoring import SCORERS
    from quarry.plans import catalog as C

    rows = [(q if q else None, p, p, *[float((p * k + (q or 0)) % 7) for k in range(1, 6)]) for q in range(4) for p in range(30)]
    scored = spark.createDataFrame(rows, "qid long, pid long, ord long, " + ", ".join(f"{s} double" for s in SCORERS))
    want = sorted((s, q or 0, p, float(r[3 + i]), rank + 1) for i, s in enumerate(SCORERS) for q in {r[0] for r in rows}
                  for rank, r in enumerate(sorted((r for r in rows if r[0] == q), key=lambda r: (-r[3 + i], r[2]))) for p in [r[1]])
    small, large = (C.ranked_runs(scored, 30, w) for w in (100, 10))
    for df in (small, large):
        assert sorted((r.algoname, r.qid or 0, r.pid, r.score, r["rank"]) for r in df.select("algoname", "qid", "pid", "score", "rank").collect()) == want
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("Generate") < plan.index("Exchange hash")  # the pairs move once, before they are dealt to runs
