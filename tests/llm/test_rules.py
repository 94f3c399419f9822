"""Operators 4, 6, 8, 10."""

import math
import re
import zlib
from collections import Counter

import pytest
from helpers import EDGE, edge, none, words

from quarry.llm import language_mixture, license_scan, quality_rules, rule_ensemble


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


# --- 10 quality rules

def brute_metrics(text):
    ws, t = words(text), text or ""
    grams = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    many = {g for g in grams if grams.count(g) > 1}
    covered = {q for i, g in enumerate(grams) if g in many for q in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if words(x)]
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def test_quality_metrics_match_brute_force(spark):
    texts = [t for _, t in EDGE if t is None or len(t) < 5000]
    texts += ["a b c a b c a b", "a a a a a", "x y", "p q r s p q r\n\np q r s p q r\n", "#a *b | <c>\n#a *b | <c>", "é é é é"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: tuple(r[1:6]) for r in quality_rules.apply_rules(rows).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()}
    assert got == {i: brute_metrics(t) for i, t in enumerate(texts)}


def test_quality_rules_edge_rows(spark):
    out = quality_rules.apply_rules(edge(spark, extra=True)).collect()
    assert len(out) == len(EDGE)
    assert all(r.base_failed and not r.kept for r in out if r.n_words < 50)
    assert quality_rules.apply_rules(none(spark)).count() == 0


def test_rule_table_is_a_parameter(spark):
    rows = spark.createDataFrame([(1, "the and " + " ".join(f"w{i}" for i in range(60)))], "doc_id long, text string")
    assert quality_rules.apply_rules(rows).first().kept
    strict = (quality_rules.Rule("too_long", "n_words", "<=", 10),)
    r = quality_rules.apply_rules(rows, strict).first()
    assert (r.kept, r.broken_rules) == (False, "too_long")
    assert quality_rules.apply_rules(rows, ()).first().kept


# --- 4 rule ensemble

def make_labelled(spark, n=300):
    good = [(i, "the house of the rain and the sea is in the north. " * 5, 1) for i in range(n)]
    bad = [(n + i, "BUY!! NOW!! ### $$$ | " * 12, 0) for i in range(n)]
    rows = spark.createDataFrame(good + bad, "doc_id long, text string, quality int")
    return rows.select("doc_id", "text"), rows.select("doc_id", "quality")


def test_rule_ensemble_learns_and_holds_out(spark):
    docs, labels = make_labelled(spark)
    out = {r.doc_id: r for r in rule_ensemble.classify(docs, labels).collect()}
    assert all(r.held_out == held_out(i) for i, r in out.items())
    assert all(r.predicted == (1 if i < 300 else 0) and 0 <= r.score <= 1 for i, r in out.items())
    # labels of held-out rows are never learned from: flipping them changes nothing
    flipped = spark.createDataFrame([(i, 1 - q if held_out(i) else q) for i, q in labels.collect()], labels.schema)
    again = {r.doc_id: r.score for r in rule_ensemble.classify(docs, flipped).collect()}
    assert again == pytest.approx({i: r.score for i, r in out.items()})
    assert rule_ensemble.keep_good(docs, labels).count() == 300


def test_compiled_rules_equal_plain_conditions(spark, small):
    """The compiled column against the rules and weights applied one by one in plain Python."""
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    docs = spark.createDataFrame([*small, (9001, None), (9002, ""), (9003, "!!! A|B 12")], "doc_id long, text string")
    model = rule_ensemble.fit(rule_ensemble.training_rows(docs, labels))
    assert any(len(r) > 1 for r in model.weights)
    rows = rule_ensemble.statistics(docs).select("doc_id", *rule_ensemble.FEATURES, model.score().alias("score")).collect()
    for r in rows:
        z = model.intercept
        for rule, w in model.weights.items():
            if all((r[c.feature] > c.bound) if c.above else (r[c.feature] <= c.bound) for c in rule):
                z += w
        assert r.score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-12)
    assert {r.doc_id: r.score for r in rule_ensemble.classify(docs, labels).collect()} == pytest.approx({r.doc_id: r.score for r in rows})


def brute_statistics(text):
    t, ws = text or "", words(text)
    n, c, lines = max(len(ws), 1), max(len(t), 1), t.split("\n")
    return {"log_words": math.log1p(len(ws)), "word_chars": len(t) / n, "caps": sum(x in rule_ensemble.UPPER for x in t) / c,
            "digits": sum(x in "0123456789" for x in t) / c, "marks": sum(x in rule_ensemble.MARKS for x in t) / n,
            "bangs": sum(x in "!?" for x in t) / n, "bars": t.count("|") / n, "types": len(set(ws)) / n,
            "same_as_last": sum(a == b for a, b in zip(ws, ws[1:])) / n, "function_words": len(set(ws) & set(rule_ensemble.FUNCTION_WORDS)),
            "line_words": len(ws) / len(lines), "dup_lines": 1 - len(set(lines)) / len(lines)}


def test_statistics_match_brute_force(spark, small):
    rows = [*small, *[(9000 + i, t) for i, (_, t) in enumerate(EDGE)]]
    got = {r.doc_id: r for r in rule_ensemble.statistics(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        assert {f: got[i][f] for f in rule_ensemble.FEATURES} == pytest.approx(brute_statistics(t), abs=1e-9), i


def test_rule_ensemble_edge_rows(spark):
    docs, labels = make_labelled(spark, 60)
    out = rule_ensemble.classify(edge(spark, extra=True).unionByName(docs, allowMissingColumns=True), labels).collect()
    assert len(out) == len(EDGE) + 120 and all(0 <= r.score <= 1 for r in out)
    assert rule_ensemble.classify(none(spark), labels).count() == 0
    nothing = labels.where("false")
    assert {r.score for r in rule_ensemble.classify(docs, nothing).collect()} == {0.5}
    alike = rule_ensemble.classify(docs, labels.where("quality = 1")).collect()
    assert len({r.score for r in alike}) == 1 and alike[0].score > 0.9
    assert sorted(rule_ensemble.keep_good(edge(spark, extra=True), labels.where("quality = 1")).columns) == sorted(edge(spark, extra=True).columns)


# --- 6 licence scan

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def brute_base(text):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    places = [(i, lab) for ph, lab in BASE.items() for i in range(len(ws)) if ws[i:i + len(ph.split())] == ph.split()]
    at = [i for i, _ in places]
    return len(ws), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({lab for _, lab in places}))


def test_license_base_matches_brute_force(spark, small):
    planted = ["CC-BY cc by CC\nBY", "General Public  License, all rights reserved", "general public general public license",
               "licensed under the Apache License, Version 2.0", "Released under the MIT License.", "all rights", "ÀLL rights reserved all rights reserved",
               "GNU General Public License, version 3. Licensed under CC BY-NC 4.0."]
    docs = [*small, *[(10_000 + i, t) for i, t in enumerate(planted)], *[(20_000 + i, t) for i, (_, t) in enumerate(EDGE)]]
    out = license_scan.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out}
    assert got == {i: brute_base(t) for i, t in docs}
    labels = {r.doc_id: r.labels for r in out}
    assert labels[10_003] == "apache-2.0" and labels[10_004] == "mit"
    assert labels[10_007] == "cc-by,cc-by-nc,gpl,gpl-3.0"
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in out)


def test_license_edge_rows(spark):
    assert license_scan.scan(edge(spark, extra=True)).count() == len(EDGE)
    assert license_scan.scan(none(spark)).count() == 0
    # every document has the phrase: its words are common, yet no place is lost
    docs = spark.createDataFrame([(i, "x all rights reserved y") for i in range(40)], "doc_id long, text string")
    assert {(r.n_base, r.first_word) for r in license_scan.scan(docs).collect()} == {(1, 1)}


# --- 8 language mixture

def brute_trigrams(text):
    s = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    s = re.sub(" +", " ", f" {s} ")
    key = lambda a, b, c: ((ord(a) << 42 | ord(b) << 21 | ord(c)) * 0x9E3779B97F4A7C15 % (1 << 64)) >> 48
    return Counter(key(*s[i:i + 3]) for i in range(len(s) - 2))


def brute_mixture(likelihood, langs, grams):
    """Greedy penalised mixture by plain loops; ``likelihood(lang, gram)``."""
    total = sum(grams.values())

    def em(chosen):
        share = {x: 1 / len(chosen) for x in chosen}
        for _ in range(language_mixture.EM_ROUNDS):
            new = dict.fromkeys(chosen, 0.0)
            for g, n in grams.items():
                joint = {x: likelihood(x, g) * share[x] for x in chosen}
                for x in chosen:
                    new[x] += n * joint[x] / sum(joint.values())
            share = {x: v / total for x, v in new.items()}
        return sum(n * math.log(sum(likelihood(x, g) * share[x] for x in chosen)) for g, n in grams.items()), share

    single = {x: sum(n * math.log(likelihood(x, g)) for g, n in grams.items()) for x in langs}
    best = max(langs, key=lambda x: single[x])
    everything = em(langs)[1]
    chosen, level, share = [best], single[best], {best: 1.0}
    price = language_mixture.PENALTY * math.log(total + 1)
    for x in sorted((x for x in langs if x != best), key=lambda x: -everything[x]):
        trial, weights = em([*chosen, x])
        if trial - price * len(chosen) <= level - price * (len(chosen) - 1):
            break
        chosen, level, share = [*chosen, x], trial, weights
    return share


def test_mixtures_match_brute_force(spark, small):
    langs = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    by = {x: [t for i, t in small if langs[i] == x] for x in sorted({x for x in langs.values() if x})}
    rows = [(i, t, langs[i]) for i, t in small[:120]]
    texts = [t for ts in by.values() for t in ts[:2]] + [" ".join(ts[0][:1500] for ts in list(by.values())[:2]), "x", "9 9", ""]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    counts = {x: Counter() for x in sorted({x for _, _, x in rows if x})}
    for i, t, x in rows:
        if x and not held_out(i):
            counts[x].update(brute_trigrams(t))
    size = {x: sum(c.values()) + language_mixture.SMOOTHING * language_mixture.BUCKETS for x, c in counts.items()}
    likelihood = lambda x, g: (counts[x][g] + language_mixture.SMOOTHING) / size[x]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: dict(zip(r.languages, r.proportions)) for r in language_mixture.identify(asked, language_mixture.learn(docs)).collect()}
    for i, t in enumerate(texts):
        grams = brute_trigrams(t)
        assert got[i] == (pytest.approx(brute_mixture(likelihood, list(counts), grams), abs=1e-6) if any(c.isalpha() for c in t) else {}), t[:40]
    assert max(len(x) for x in got.values()) > 1


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    out = language_mixture.identify(docs, language_mixture.learn(docs)).join(docs, "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in out) / len(out) > 0.95
    assert all(0 <= r.score <= 1 for r in out)


def test_more_languages_than_one_matrix_holds(spark):
    def text(k):
        return " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}{x}" for x in ("po", "ra", "mi", "tun", "sel")) + " the"

    n = language_mixture.MAX_LANGS + 44
    train = [(1000 * j + k, text(k) * 3, f"l{k:03d}") for k in range(n) for j in range(4)]
    train = [r for r in train if not held_out(r[0])]
    assert len({r[2] for r in train}) > language_mixture.MAX_LANGS
    model = language_mixture.learn(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    assert model.langs == sorted({r[2] for r in train})
    asked = [k for k in range(n) if f"l{k:03d}" in model.langs]
    out = language_mixture.identify(spark.createDataFrame([(k, text(k)) for k in asked], "doc_id long, text string"), model).collect()
    assert {r.doc_id: r.lang_pred for r in out} == {k: f"l{k:03d}" for k in asked}
    assert language_mixture.identify(edge(spark, extra=True), model).count() == len(EDGE)


def test_wide_model_gives_the_same_mixtures(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    asked = docs.select("doc_id", "text").union(spark.createDataFrame(
        [(-1, "the rain and the sea of the north " * 30 + "la pluie et les eaux du nord dans une ville " * 30), (-2, "123 !!"), (-3, None)],
        "doc_id long, text string"))

    def found():
        model = language_mixture.learn(docs)
        return type(model).__name__, {r.doc_id: r for r in language_mixture.identify(asked, model).collect()}

    kind, want = found()
    monkeypatch.setattr(language_mixture, "MAX_LANGS", 2)
    monkeypatch.setattr(language_mixture, "BLOCK_ENTRIES", 3000)
    monkeypatch.setattr(language_mixture, "TRIGRAMS_AT_ONCE", 500)
    wide, got = found()
    assert (kind, wide) == ("Model", "WideModel") and got.keys() == want.keys()
    assert any(len(r.languages) > 1 for r in want.values())
    for i, r in want.items():
        assert (got[i].lang_pred, got[i].languages, got[i].held_out) == (r.lang_pred, r.languages, r.held_out)
        assert got[i].proportions == pytest.approx(r.proportions, rel=1e-6)


def test_language_mixture_and_edge_rows(spark):
    en, fr = "the rain and the sea of the north ", "la pluie et les eaux du nord dans une ville "
    train = [(i, en * 5, "en") for i in range(30)] + [(100 + i, fr * 5, "fr") for i in range(30)] + [(200, "zzz", None), (None, "abc", "xx")]
    model = language_mixture.learn(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    assert model.langs == ["en", "fr"]
    test = spark.createDataFrame([(1, en * 40 + fr * 40), (2, en), (3, fr), (4, "123 !!"), (5, None)], "doc_id long, text string")
    out = {r.doc_id: r for r in language_mixture.identify(test, model).collect()}
    assert sorted(out[1].languages) == ["en", "fr"] and max(out[1].proportions) < 0.75
    assert (out[2].languages, out[3].languages) == (["en"], ["fr"])
    assert [(out[i].lang_pred, out[i].score) for i in (4, 5)] == [("und", 0.0)] * 2
    assert language_mixture.identify(edge(spark, extra=True), model).count() == len(EDGE)
    empty = language_mixture.learn(none(spark))
    assert {r.lang_pred for r in language_mixture.identify(edge(spark), empty).collect()} == {"und"}
    assert language_mixture.identify(none(spark), model).count() == 0
