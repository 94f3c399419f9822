"""Operators 1, 2, 5, 9 and 3."""

import hashlib
import random
from itertools import combinations

import pytest
from helpers import EDGE, Groups, edge, lower, none, words

from quarry.llm import edit_decontamination as decon
from quarry.llm import jaccard_join, line_dedup, lz_dedup, revisit_resolution
from quarry.llm.common import components

WORDS = [f"w{i}" for i in range(40)]


def near_texts(seed, n, size, edits):
    """Texts that share long passages: edited copies of a few originals."""
    rnd = random.Random(seed)
    bases = [[rnd.choice(WORDS) for _ in range(size)] for _ in range(3)]
    out = []
    for i in range(n):
        ws = list(rnd.choice(bases))
        for _ in range(rnd.randint(0, edits)):
            k = rnd.randrange(len(ws))
            ws[k:k + 1] = rnd.choice([[], ["new"], [rnd.choice(WORDS), rnd.choice(WORDS)]])
        a = rnd.randrange(len(ws) // 2)
        out.append((i, " ".join(ws[a:] if rnd.random() < 0.3 else ws)))
    return out


# --- components

def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(1, 12)] + [(100, 101), (7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 1 for i in range(1, 13)}, 100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 5 substring dedup

def brute_lz(rows, window):
    first, result = {}, {}
    for i, text in sorted((r for r in rows if r[0] is not None and r[1]), key=lambda r: r[0]):
        ws = words(text)
        for k in range(len(ws) - window + 1):
            key = tuple(ws[k:k + window])
            first[key] = min(first.get(key, i), i)
    for i, text in rows:
        ws = words(text)
        gone = set()
        for k in range(len(ws) - window + 1):
            if i is not None and first[tuple(ws[k:k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(ws) if k not in gone)
        result.setdefault(i, []).append((len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return {i: sorted(v) for i, v in result.items()}


def got_lz(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append((r.n_words, r.n_removed, r.kept_sha256))
    return {i: sorted(v) for i, v in out.items()}


@pytest.mark.parametrize("seed", range(2))
def test_lz_dedup_matches_brute_force(spark, seed):
    rows = near_texts(seed, 30, 60, 4) + [(100, "a " * 40), (101, "a " * 60), (102, "b a " * 20)]
    rows = [(i, f"{t} {t}" if i % 7 == 0 else t) for i, t in rows]  # repeats inside a document
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for window, anchor in ((10, 4), (12, 12), (7, 1)):
        assert got_lz(lz_dedup.dedup(df, window=window, anchor=anchor)) == brute_lz(rows, window)


def test_lz_dedup_edge_rows(spark):
    got = got_lz(lz_dedup.dedup(edge(spark, extra=True), window=10, anchor=4))
    assert got == brute_lz(EDGE, 10)
    assert lz_dedup.dedup(none(spark)).count() == 0


# --- 9 Jaccard join

def brute_jaccard(rows):
    sets, groups = {}, Groups()
    for i, text in rows:
        ws = words(lower(text))
        sets[i] = {tuple(ws[k:k + 5]) for k in range(len(ws) - 4)} if len(ws) >= 5 else ({tuple(ws)} if ws else set())
    for a, b in combinations([i for i in sets if i is not None], 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            groups.link(a, b)
    return {i: (len(s), groups.root(i) if i is not None else None) for i, s in sets.items()}


@pytest.mark.parametrize("seed", range(2))
def test_jaccard_matches_brute_force(spark, seed, monkeypatch):
    rows = near_texts(seed, 60, 120, 8)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # both ways of fetching candidate texts, and every shingle of the sample frequent or few of them
    monkeypatch.setattr(jaccard_join, "SAMPLE", 1 + seed)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard_join.jaccard_components(df, broadcast_ids=(1_000_000, 0)[seed]).collect()}
    assert got == brute_jaccard(rows)


def test_jaccard_rows_of_one_id_are_one_node(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(2, b), (5, a + " q"), (5, b + " q"), (1, a), (7, a + " q"), (5, None), (9, "")]
    got = {(r[0], r[2]) for r in jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1), (2, 1), (5, 1), (7, 1), (9, 9)}


def test_jaccard_documents_with_one_passage_are_not_paired(spark, monkeypatch):
    """A passage in every text and nothing else in common, no list of frequent
    shingles to help: blocks of members meet, hardly any pair leaves them."""
    monkeypatch.setattr(jaccard_join, "HOT_SEEN", 1 << 40)
    rnd, seen = random.Random(4), []
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, " ".join(f"x{rnd.randrange(10 ** 7)}" for _ in range(120)) + " " + passage) for i in range(1000)]
    real = jaccard_join.cross_pairs
    monkeypatch.setattr(jaccard_join, "cross_pairs", lambda *a, **k: seen.append(real(*a, **k)) or seen[-1])
    out = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert all(r.doc_id == r.component_id for r in out) and len(out) == 1000
    assert seen[0].count() < 1000


def test_jaccard_chain_of_edits(spark):
    """Neighbours link, ends do not: heads and derived answers must keep the chain whole."""
    rnd = random.Random(5)
    ws, rows = [f"t{i}" for i in range(200)], []
    for i in range(25):
        rows.append((i, " ".join(ws)))
        for _ in range(3):
            ws[rnd.randrange(200)] = f"x{rnd.random()}"
    rows = [(i * 7 % 25, t) for i, t in rows]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_jaccard(rows)


def test_jaccard_edge_rows(spark):
    out = jaccard_join.jaccard_components(edge(spark, extra=True)).collect()
    assert len(out) == len(EDGE)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in out} == {(i, *v) for i, v in brute_jaccard(EDGE).items()}
    assert jaccard_join.jaccard_components(none(spark)).count() == 0


# --- 2 line dedup

def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_lines(rows, min_words=5):
    lines = sorted({(i, k, tuple(words(x.lower()))) for i, t in rows if i is not None and t is not None
                    for k, x in enumerate(t.split("\n")) if words(x)})
    gone, before = {}, []
    for i, k, ws in lines:
        for old in before:
            if old == ws or (min(len(old), len(ws)) >= min_words and abs(len(old) - len(ws)) <= 1 and edit_distance(old, ws) <= 1):
                gone.setdefault(i, []).append(k)
                break
        before.append(ws)
    return gone


def test_line_dedup_matches_brute_force(spark):
    rnd = random.Random(3)
    base = [[rnd.choice(WORDS[:12]) for _ in range(rnd.randint(1, 9))] for _ in range(12)] + [["r"] * 6, ["r"] * 7, ["a", "a", "b", "b", "b"]]
    rows = []
    for i in range(25):
        lines = []
        for _ in range(8):
            ws = list(rnd.choice(base))
            if rnd.random() < 0.6:
                k = rnd.randrange(len(ws) + 1)
                ws[k:k + rnd.randint(0, 1)] = rnd.choice([[], [rnd.choice(WORDS[:12])]])
            lines.append(rnd.choice([" ", "\t ", "  "]).join(w.upper() if rnd.random() < 0.1 else w for w in ws))
        rows.append((i * 3 % 25, "\n".join(lines)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_lines(rows)
    for limit in (1_000_000, 0):
        got = {r.doc_id: list(r.dropped) for r in line_dedup.dedup(df, broadcast_ids=limit).collect() if r.n_dropped}
        assert got == want
    texts = dict(rows)
    for r in line_dedup.dedup(df).collect():
        kept = "\n".join(x for k, x in enumerate(texts[r.doc_id].split("\n")) if k not in want.get(r.doc_id, []))
        assert r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_clean_keeps_columns_of_any_name(spark):
    names = ["dropped", "dropped__", "lines", "lines__", "kept", "kept__", "row", "line_no"]
    rows = [(1, "a line of five words here", *names), (2, "a line of five words here\nmore", *names), (3, None, *names)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    assert sorted(map(tuple, line_dedup.clean(df).collect())) == [rows[0], (2, "more", *names), rows[2]]


def test_line_dedup_edge_rows(spark):
    out = line_dedup.dedup(edge(spark, extra=True)).collect()
    assert len(out) == len(EDGE)
    assert {r.doc_id: list(r.dropped) for r in out if r.n_dropped} == brute_lines(EDGE) == {5: [1], 6: [0, 1]}
    cleaned = line_dedup.clean(edge(spark, extra=True))
    assert cleaned.columns == edge(spark, extra=True).columns
    assert sorted(str(r.doc_id) for r in cleaned.collect()) == sorted(str(i) for i, _ in EDGE if i != 6)
    assert line_dedup.dedup(none(spark)).count() == 0


# --- 1 benchmark decontamination

def brute_leaks(docs, items, rate):
    import re
    tok = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    out = {}
    for d, text in docs:
        ws = tok(text)
        for j, item in items:
            pat = tok(item)
            if not pat:
                continue
            row, best = [0] * (len(ws) + 1), None  # the match may begin anywhere
            for i, x in enumerate(pat, 1):
                last, row[0] = row[0], i
                for k, y in enumerate(ws, 1):
                    last, row[k] = row[k], min(row[k] + 1, row[k - 1] + 1, last + (x != y))
            best = min(row)
            if best <= decon.budget(len(pat), rate):
                out[d, j] = best
    return out


@pytest.mark.parametrize("rate", [0.0, 0.15, 0.3])
def test_decontamination_matches_brute_force(spark, rate):
    rnd = random.Random(9)
    items = [(j, " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(8, 70)))) for j in range(12)] + [(50, None), (51, "two more"), (52, ""), (54, "edit"), (55, "...")]
    items += [(60 + n, " ".join(items[n][1].split()[:n])) for n in range(1, 8)]
    items.append((53, items[0][1]))
    docs = []
    for i in range(40):
        ws = items[rnd.randrange(12)][1].split()
        for _ in range(rnd.randint(0, 12)):
            k = rnd.randrange(len(ws))
            ws[k:k + 1] = rnd.choice([[], ["edit"], ["two", "more"]])
        docs.append((i, ", ".join([rnd.choice(WORDS) for _ in range(rnd.randint(0, 20))]) + " " + " ".join(ws).upper() + ". " + "tail " * rnd.randint(0, 9)))
    docs += [(100, None), (101, ""), (None, items[1][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    for block in (1 << 20, 200):
        got = {(r.doc_id, r.item_id): r.distance for r in decon.leaks(d, b, rate=rate, block_bytes=block).collect()}
        assert got == brute_leaks(docs, items, rate)


def test_decontamination_edge_rows(spark):
    b = spark.createDataFrame([(1, "an item of the benchmark with quite enough words")], "item_id long, text string")
    assert decon.leaks(edge(spark, extra=True), b).count() == 0
    assert decon.clean(edge(spark, extra=True), b).count() == len(EDGE)
    assert decon.leaks(none(spark), b).count() == 0
    assert decon.leaks(edge(spark), b.where("false")).count() == 0
    hit = spark.createDataFrame([(1, "x An item of the BENCHMARK, with quite enough words! y"), (2, "clean")], "doc_id long, text string")
    r = decon.leaks(hit, b).first()
    assert (r.distance, r.first_word, r.last_word) == (0, 1, 9)
    assert [x.doc_id for x in decon.clean(hit, b).collect()] == [2]


def test_short_items_are_found_word_for_word(spark):
    b = spark.createDataFrame([(1, "Who wrote the first novel ever?"), (2, "unseen words")], "item_id long, text string")
    d = spark.createDataFrame([(1, "he asked who wrote the first novel ever and left"), (2, "who wrote the second novel ever")], "doc_id long, text string")
    assert [(r.doc_id, r.item_id, r.distance) for r in decon.leaks(d, b).collect()] == [(1, 1, 0)]


# --- 3 revisits

RECORD = "record_id string, url string, time long, type string, headers map<string,string>, digest string, payload string"


def resolved(spark, rows):
    return {r.revisit_id: r for r in revisit_resolution.resolve(spark.createDataFrame(rows, RECORD)).collect()}


def test_revisit_takes_latest_earlier_response(spark):
    rows = [("r1", "http://www.A.com:80/p/?b=2&a=1#x", 10, "response", {"ETag": '"1"', "Content-Length": "5", "X": "old"}, "d1", "one"),
            ("r2", "https://a.com/p?a=1&b=2", 20, "response", {"ETag": 'W/"2"', "X": "old"}, "d2", "two"),
            ("r3", "https://a.com/p?a=1&b=2", 30, "response", {"ETag": '"3"'}, "d3", "three"),
            ("v0", "http://a.com/p?a=1&b=2", 10, "revisit", {"etag": '"1"'}, None, None),
            ("v1", "http://a.com/p/?a=1&b=2", 15, "revisit", {"etag": 'W/"1"', "x": "new", "content-length": "0"}, None, None),
            ("v2", "http://u@a.com/p?b=2&a=1", 30, "revisit", {"etag": '"2"'}, None, None),
            ("v3", "http://a.com/p?a=1&b=2", 99, "revisit", {"etag": '"2"'}, None, None),
            ("v4", "http://a.com/q", 99, "revisit", {}, None, None), ("v5", None, 99, "revisit", None, None, None),
            ("v6", "http://a.com/p?a=1&b=2", None, "revisit", None, None, None), ("v7", "not a url", 99, "revisit", None, None, None),
            ("v8", "http://a.com/p?a=1&b=2", 99, "revisit", None, "d3", None), ("v9", "http://a.com/p?a=1&b=2", 99, "revisit", None, None, None)]
    out = resolved(spark, rows)
    assert {k: (r.response_id, r.status) for k, r in out.items()} == {
        "v0": (None, "no_response"), "v1": ("r1", "resolved"), "v2": ("r2", "resolved"), "v3": ("r3", "mismatch"),
        "v4": (None, "no_response"), "v5": (None, "no_response"), "v6": (None, "no_response"), "v7": (None, "no_response"),
        "v8": ("r3", "resolved"), "v9": ("r3", "unverifiable")}
    assert out["v1"].headers == {"etag": 'W/"1"', "content-length": "5", "x": "new"} and out["v1"].payload == "one"
    assert out["v3"].payload is None and revisit_resolution.resolve(spark.createDataFrame([], RECORD)).count() == 0


def test_repeated_records_are_answered_one_by_one(spark):
    url, ask = "http://a.com/p", "revisit"
    rows = [("r1", url, 10, "response", {"etag": "1"}, "d1", "one"), ("r1", url, 20, "response", {"etag": "2"}, "d2", "two"),
            ("v1", url, 15, ask, {"etag": "1"}, None, None), ("v1", url, 30, ask, {"etag": "2"}, None, None), ("v1", url, 30, ask, {"etag": "1"}, None, None),
            ("r5", url, 40, "response", {"etag": "5"}, "a", "low"), ("r5", url, 40, "response", {"etag": "6"}, "b", "high"), ("v5", url, 50, ask, {"etag": "6"}, None, None)]
    out = revisit_resolution.resolve(spark.createDataFrame(rows, RECORD)).collect()
    assert sorted((r.revisit_id, r.time, r.response_id, r.status, r.payload or "") for r in out) == [
        ("v1", 15, "r1", "resolved", "one"), ("v1", 30, "r1", "mismatch", ""), ("v1", 30, "r1", "resolved", "two"), ("v5", 50, "r5", "resolved", "high")]


def test_derived_captures_meet_every_status(spark):
    records = revisit_resolution.capture_records(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))
    n = {r.status: r["count"] for r in revisit_resolution.resolve(records).groupBy("status").count().collect()}
    assert n.keys() == {"resolved", "mismatch", "unverifiable", "no_response"} and min(n.values()) > 1, n


def test_revisits_of_a_hot_url_match_brute_force(spark):
    rnd = random.Random(1)
    rows = [(f"{k}{i}", f"http://h.com/{0 if rnd.random() < 0.7 else rnd.randrange(5)}", rnd.randrange(120), k and {"r": "response", "v": "revisit"}[k],
             {"etag": str(rnd.randrange(2))}, None, f"p{i}") for i in range(300) for k in [rnd.choice("rv")]]
    rows += rows[:20]  # repeated records
    want = {}
    for rid, url, t, kind, h, _, _ in rows:
        if kind == "revisit":
            found = max(((x[2], x[0], x[4]) for x in rows if x[3] == "response" and x[1] == url and x[2] < t), default=None)
            want[rid] = (found[1], "resolved" if found[2] == h else "mismatch") if found else (None, "no_response")
    df = spark.createDataFrame(rows, RECORD).withColumn("key", revisit_resolution.F.lit("clash"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keep the hot URL on several ranges
    try:
        out = revisit_resolution.resolve(df).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert {r.revisit_id: (r.response_id, r.status) for r in out} == want
    assert len(out) == sum(r[3] == "revisit" for r in rows)
