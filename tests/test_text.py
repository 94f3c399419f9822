from pyspark.sql import functions as F

from quarry.functions import text as T


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "s string").select(expr(F.col("s")).alias("o")).first()["o"]


def test_index_analyzer_golden(spark):
    assert one(spark, T.index_tokens, "What is a Pizza, in 2019-2020?") == \
        ["wh", "t", "is", "pi", "in", "2", "1", "2", "2"]
    assert one(spark, T.index_tokens, "blue sky  day") == ["blue", "sky", "d", "y"]


def test_lengths(spark):
    assert one(spark, T.word_count, "blue sky  day") == 4
    assert one(spark, lambda c: F.size(T.ws_tokens(c)), "blue sky  day") == 3
    assert one(spark, T.word_count, None) == 1          # 'nan'
    assert one(spark, T.index_tokens, None) == []


def test_whitespace_matches_python_split(spark):
    samples = ["a b c\x1cd\te\n\nf", "  lead and trail  ", "x　y z", "", "one"]
    for s in samples:
        assert one(spark, T.ws_tokens, s) == s.split(), repr(s)


def test_index_tokens_match_python_loop(spark):
    text = "Über CAFÉ: naïve—test [x] {y} 0909 azAZ ★tag… “quoted” ‘single’"
    expected = text.lower()
    for ch in T.INDEX_BLANK_CHARS:
        expected = expected.replace(ch, " ")
    assert one(spark, T.index_tokens, text) == expected.split()


def test_word_list_html(spark):
    html = ("<!DOCTYPE html><html><head><style>p{x:1}</style><script>var a='<p>';</script></head>"
            "<body><!-- hidden --><p>Hello, <b>World</b>&amp;friends 42</p></body></html>")
    assert one(spark, T.word_list, html) == ["hello", "world", "friends"]
    assert one(spark, lambda c: T.word_list(c, remove_stopwords=True), "<p>The cat and the hat</p>") == ["cat", "hat"]


def test_sentences(spark):
    out = one(spark, T.raw_sentences, "  One two. Three!  Four? five ")
    assert out == ["One two.", "Three!", "Four?", "five"]
