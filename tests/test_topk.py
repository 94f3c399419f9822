"""Block-coded postings and block-max top-k against plain rows and full scoring."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators.ranking import score_key, top_k_within
from quarry.operators.scoring import Retrieval
from quarry.operators.topk import BlockMaxTopK, bm25_top
from quarry.sources import posting_blocks as pb
from quarry.sources.passage_index import PassageIndex


def test_varints_of_every_length():
    v = np.array([0, 1, 127, 128, 16383, 16384, *[(1 << 7 * k) - 1 for k in range(1, 9)], *[1 << 7 * k for k in range(1, 9)], (1 << 62) + 5])
    data, at = pb.varints(v)
    assert (pb.from_varints(data) == v).all() and at[-1] == len(data)
    assert len(pb.from_varints(np.empty(0, np.uint8))) == 0


def test_blocks_decode_to_the_same_rows_over_any_batches():
    rng = np.random.default_rng(0)
    rows = sorted({(f"t{rng.integers(0, 9)}", int(rng.integers(-500, 10 ** 9))) for _ in range(3000)})
    full = pa.record_batch([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array(rng.integers(1, 300, len(rows))),
                            pa.array(rng.integers(0, 40000, len(rows)))], names=["term", "pid", "count", "len"])
    cuts = [0, 7, 500, 500, 1200, len(rows)]
    blocks = list(pb.encode_batches((full.slice(a, b - a) for a, b in zip(cuts, cuts[1:])), 128))
    assert pa.Table.from_batches([pb._decoded(b) for b in blocks]).to_pydict() == pa.Table.from_batches([full]).to_pydict()
    per_term = {t: sum(r[0] == t for r in rows) for t, _ in rows}
    assert sum(b.num_rows for b in blocks) == sum(-(-n // 128) for n in per_term.values())
    table = pa.Table.from_batches(blocks).to_pylist()
    flat = full.to_pylist()
    for b in table:
        own = [r for r in flat if r["term"] == b["term"] and b["first_pid"] <= r["pid"] <= b["last_pid"]]
        assert (b["n"], b["max_count"], b["min_len"], b["sum_count"]) == (
            len(own), max(r["count"] for r in own), min(r["len"] for r in own), sum(r["count"] for r in own))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Passages with a skewed vocabulary, upper-case and dotted words, empty and
    repeated ones; rare words in few passages."""
    rng = random.Random(6)
    common, rare = ["the", "of", "and", "to"], [f"rare{i}" for i in range(60)]
    mid = [f"mid{i}" for i in range(40)]
    rows = []
    for i in range(900):
        words = rng.choices(common, k=rng.randrange(2, 25)) + rng.choices(mid, k=rng.randrange(0, 8))
        words += rng.choices(rare, k=1) * rng.randrange(1, 4) if rng.random() < 0.2 else []
        rng.shuffle(words)
        rows.append((i * 7 - 300, " ".join(words), i))
    rows += [(90_000, "", 900), (90_001, None, 901), (90_002, "The. mid1. RARE1", 902), (90_003, "rare1 mid1", 903), (90_004, "rare1 mid1", 904)]
    passages = spark.createDataFrame(rows, "pid long, passage string, ord long")
    queries = [(0, "rare1 rare2 the of and"), (1, "rare3 mid1 mid2 the the to"), (2, "the of and to"), (3, "unknown words only"), (4, ""), (5, None),
               (6, "mid3 mid4 mid5 mid6 the"), (7, "rare4"), (8, "rare1 mid1"), (9, "The. mid1."), (10, "rare5 " + " ".join(mid))]
    return passages, spark.createDataFrame(queries, "qid long, query string"), PassageIndex.build(passages, str(tmp_path_factory.mktemp("topk") / "idx"))


def ranked(df):
    return sorted((r.qid, r["rank"], r.pid, round(r.score, 7)) for r in df.collect())


@pytest.mark.parametrize("k", [1, 10, 100])
def test_top_k_equals_full_scoring(spark, corpus, k):
    passages, queries, index = corpus
    want = top_k_within(Retrieval(index, queries).bm25(), ["qid"], [score_key("score"), F.col("ord")], k)
    assert ranked(bm25_top(Retrieval(index, queries), k)) == ranked(want)


def test_few_postings_are_read_where_rare_terms_decide(spark, tmp_path):
    """Topics of 12 neighbouring passages with a word of their own, among words of nearly half of all passages."""
    rng = random.Random(2)
    big = [f"big{i}" for i in range(12)]
    rows = [(i, " ".join([f"topic{i // 12}"] * rng.randrange(1, 4) + [w for w in big if rng.random() < 0.45]), i) for i in range(6000)]
    index = PassageIndex.build(spark.createDataFrame(rows, "pid long, passage string, ord long"), str(tmp_path / "idx"))
    queries = spark.createDataFrame([(t, f"topic{t} big1 big2 big{t % 12} big{t % 5}") for t in (3, 4)], "qid long, query string")
    top = BlockMaxTopK(Retrieval(index, queries), 5, probe=4)
    got = ranked(top.run())
    assert got == ranked(top_k_within(Retrieval(index, queries).bm25(), ["qid"], [score_key("score"), F.col("ord")], 5))
    total = top.blocks.agg(F.sum("n")).first()[0]
    read = None
    for wanted in top.read.values():
        read = wanted if read is None else read.union(wanted)
    n = top.blocks.join(read.distinct(), ["term", "first_pid"], "left_semi").agg(F.sum("n")).first()[0]
    assert top.unpruned == 0 and n < 0.4 * total, (n, total)


def test_decoded_index_equals_plain_postings(spark, corpus):
    passages, _, index = corpus
    rows = passages.select("pid", F.explode(T.index_tokens("passage")).alias("term")).groupBy("term", "pid").count()
    assert sorted((r.term, r.pid, r.tf) for r in index.postings.collect()) == sorted(map(tuple, rows.collect()))
    raw = passages.select("pid", F.explode(T.ws_tokens("passage")).alias("term")).groupBy("term", "pid").count()
    assert sorted((r.term, r.pid, r.f) for r in index.raw_postings.collect()) == sorted(map(tuple, raw.collect()))


def test_given_candidates_are_not_pruned(corpus):
    _, queries, index = corpus
    with pytest.raises(ValueError):
        bm25_top(Retrieval(index, queries, queries.selectExpr("qid", "qid pid", "qid ord")), 3)
