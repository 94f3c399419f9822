"""Token alignment against the libraries and plain loops over byte ranges."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from helpers import EDGE, edge, none

from quarry.llm import token_alignment as ta

FILES = ta.TokenizerFiles.load()


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_str(FILES.a.decode())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_proto=FILES.b)


def brute(rows, library):
    a_lib, b_lib = library
    letters = ta.byte_letters()
    found, total = [], Counter()
    for doc, text in rows:
        a = b = []
        if text:
            a, b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
            spell_a = [bytes(letters[c] for c in a_lib.id_to_token(i)) for i in a]
            spell_b = []
            for i in b:
                p = b_lib.id_to_piece(i)
                spell_b.append(bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode())
            if not b"".join(spell_a) == b"".join(spell_b) == b" " + text.encode():
                a = b = []
        links, groups = [], []
        if a:
            i = j = at_a = at_b = 0
            ga, gb = [], []
            while i < len(a):
                links.append((a[i], b[j]))
                end_a, end_b = at_a + len(spell_a[i]), at_b + len(spell_b[j])
                if end_a <= end_b:
                    ga.append(a[i])
                if end_b <= end_a:
                    gb.append(b[j])
                if end_a == end_b:
                    groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
                    ga, gb = [], []
                if end_a <= end_b:
                    i, at_a = i + 1, end_a
                if end_b <= end_a:
                    j, at_b = j + 1, end_b
        total.update(links)
        found.append((doc, len(a), len(b), links, groups))
    best = Counter()
    for (_, y), n in total.items():
        best[y] = max(best[y], n)
    return sorted((str(d), na, nb, len(g), len(ls), sum(total[x] == best[x[1]] for x in ls), sum(total[x] for x in ls),
                   hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for d, na, nb, ls, g in found)


def rows_of(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


@pytest.mark.parametrize("limit", [ta.INDEX_PAIRS, 10])
def test_matches_brute_force_on_the_fixture(spark, small, library, limit, monkeypatch):
    monkeypatch.setattr(ta, "PART_PAIRS", 500)
    docs = spark.createDataFrame(small, "doc_id long, text string").repartition(5)
    assert rows_of(ta.align_corpus(docs, FILES, limit)) == brute(small, library)


@pytest.mark.parametrize("limit", [ta.INDEX_PAIRS, 0])
def test_edge_rows(spark, library, limit):
    want = brute(EDGE, library)
    assert ("7", 0, 0, 0, 0, 0, 0, "") in want  # the word mark becomes a blank
    assert rows_of(ta.align_corpus(edge(spark, extra=True), FILES, limit)) == want
    assert rows_of(ta.align_corpus(none(spark), FILES, limit)) == []


def test_special_strings_and_rare_letters(spark, library):
    texts = ["<|endoftext|> and <s></s><unk> <0x41>", "  two  blanks\t\n\n tabs  　x", "I'm you'll 12ab ٣٤ 𝒳 é ﷺ \u0085 ᠎ ﻿", "a" * 5000, "\r\n", " "]
    rows = list(enumerate(texts))
    assert rows_of(ta.align_corpus(spark.createDataFrame(rows, "doc_id long, text string"), FILES)) == brute(rows, library)


def test_perfect_hash_is_minimal_and_keys_tell_strangers(spark):
    rng = np.random.default_rng(2)
    codes = np.unique(rng.integers(0, 1 << 31, 5000))
    df = spark.createDataFrame([(int(c), int(c) % 7 + 1) for c in codes], "code long, n long")
    counts = ta.pair_counts(df.union(df), df.select("code"), len(codes))
    assert sorted(counts.index.index(codes).tolist()) == list(range(len(codes)))
    assert (counts.look_up(codes) == 2 * (codes % 7 + 1)).all()
    strangers = np.setdiff1d(rng.integers(0, 1 << 31, 5000), codes)
    assert not counts.look_up(strangers).any()


def test_sums_over_slices_and_lanes(spark, monkeypatch):
    df = spark.createDataFrame([(c, 1) for c in range(300)] * 5, "code long, n long").repartition(7)
    index = ta.perfect_hash(df.select("code").distinct(), 300, 50)
    sent = spark.sparkContext.broadcast(index)
    assert (ta.dense_sum(df, sent, "n", slice_=32, lanes=3) == 5).all()


def test_falls_back_to_the_library_where_ranks_are_not_ids():
    import json

    model = json.loads(FILES.a)
    model["model"]["merges"] = model["model"]["merges"][::-1]
    assert ta.Encoders._byte_bpe(model, {i: b"x" for i in range(60_000)}) is None
    enc = ta.Encoders._library(FILES.a)
    assert enc([" a plain text"]) == [list(x) for x in ta.Encoders(FILES)._encode_a([" a plain text"])]
