"""Operator 7."""

import random

import pytest
import sentencepiece
from helpers import EDGE, edge, none
from sentencepiece import sentencepiece_model_pb2 as pb

from quarry.llm import piece_lattice as pl


@pytest.fixture(scope="module")
def table():
    return pl.PieceTable.load()


def unigram_library(table):
    """The same pieces and scores as a unigram model of the SentencePiece library."""
    model = pb.ModelProto()
    with open(pl.MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    score = {i: s for _, i, s in table.pieces}
    for i, p in enumerate(model.pieces):
        p.score = score.get(i, 0.0)
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def brute(table, text):
    """Viterbi over the whole text at once: (score of the best path)."""
    score = {p: s for p, _, s in table.pieces}
    t = " " + text
    best = [0.0] + [float("-inf")] * len(t)
    for e in range(1, len(t) + 1):
        for s in range(max(0, e - table.longest), e):
            got = score.get(t[s:e], table.unknown if e - s == 1 else None)
            if got is not None:
                best[e] = max(best[e], best[s] + got)
    return best[-1]


def path_score(table, ids):
    score, spelled, total, run = {i: s for _, i, s in table.pieces}, table.spelled(), 0.0, b""
    for i in ids:
        if i in score:
            total += score[i]
        else:
            run += spelled[i]
            try:
                run.decode()
            except UnicodeDecodeError:
                continue
            total, run = total + table.unknown, b""
    return total


def test_best_segmentation_and_round_trip(spark, table, small):
    rows = [*small[:60], *[(1000 + k, t) for k, (_, t) in enumerate(EDGE) if t is not None and len(t) < 2000],
            (2000, "  two  blanks \n\tand ▁ mark  "), (2001, "<s></s><unk><0x41>"), (2002, " "), (2003, "日本語 \U0001f468‍\U0001f469 é")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    library = unigram_library(table)
    for frequent in (0, 300):  # all words joined, some of them, hardly any
        out = {r.doc_id: r for r in pl.decode(pl.encode(df, table, frequent=frequent), table).collect()}
        assert {i: r.decoded for i, r in out.items()} == dict(rows)
        for i, t in rows:
            if t:
                assert path_score(table, out[i].ids) == pytest.approx(brute(table, t))
    for i, t in small[:60]:  # paths of equal score may differ
        assert path_score(table, out[i].ids) == pytest.approx(path_score(table, library.encode(t)), rel=1e-5)


def test_pieces_edge_rows(spark, table):
    out = pl.round_trip(edge(spark, extra=True)).collect()
    assert len(out) == len(EDGE) and all(r.exact for r in out)
    assert {r.n_pieces for r in out if r.doc_id in (1, 2)} == {0}
    assert pl.round_trip(none(spark)).count() == 0


def test_long_word(spark, table):
    rnd = random.Random(2)
    word = "".join(rnd.choice("abcdeé") for _ in range(3000))
    r = pl.round_trip(spark.createDataFrame([(1, word)], "doc_id long, text string")).first()
    assert r.exact and path_score(table, r.ids) == pytest.approx(brute(table, word))


def test_long_words_stay_out_of_the_dictionary(spark, table):
    rnd = random.Random(3)
    word = "".join(rnd.choice("abcde") for _ in range(pl.WORD_CHARS * 5))
    rows = [(i, f"the cat {word} the cat") for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    counted = {r.word: r.n for r in pl.word_counts(df, table).collect()}
    assert counted[" cat"] == 24 and max(map(len, counted)) <= pl.WORD_CHARS
    want, got = ({r.doc_id: r.ids for r in pl.encode(df, table, frequent=k).collect()} for k in (0, 300))
    assert got == want and path_score(table, got[0]) == pytest.approx(brute(table, rows[0][1]))


def test_words_are_told_apart_when_keys_collide(table, monkeypatch):
    texts = ["the cat the dog", None, "", "a  b ▁c日本", "the cat "]
    cutter = pl.Cutter(table)
    plain = cutter.words(texts)
    monkeypatch.setattr(pl, "mix", lambda x: x * pl.U64(0))
    worst = cutter.words(texts)
    assert [plain.words[k] for k in plain.which] == [worst.words[k] for k in worst.which]
    assert list(plain.first) == list(worst.first)
    for i, t in enumerate(texts):
        assert "".join(plain.words[k] for k in plain.which[plain.first[i]:plain.first[i + 1]]) == (" " + t if t else "")
