"""Sentence boundaries learned from the corpus.

A period after a word ends a sentence unless the word is an abbreviation. Which
words are is learned without labels from how often a word type stands with and
without a final period (Kiss and Strunk, 2006): the log-likelihood ratio of "a
period nearly always follows this word" against "a period follows it as often
as any word" is scaled

* by exp(-length): abbreviations are short (inner periods do not count),
* by the number of inner periods + 1 ("e.g", "u.s"),
* by length ** -(times seen without the period): a word that also stands alone is a word.

Types that score ``THRESHOLD`` or more are abbreviations. The counts are one
grouped sum over the corpus. ``sentences`` splits after ``.``, ``!`` or ``?`` and
blank, then joins a piece to the next where its last token is an abbreviation or
an initial (one letter and a period): an expression over the split text, no user
function. Ellipses ("...") end like single periods.

Null or empty text: no sentence. Abbreviations are compared in lower case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.plans.execution import scalar_row

THRESHOLD = 0.3
#: Probability of a period after an abbreviation.
NEARLY_ALWAYS = 0.99
#: Abbreviations up to which they are compiled into the expression; more are joined.
COMPILED = 2_000
# Marks that may enclose a token.
OPENING, CLOSING = "([{\"'", ")]}\"',;:"


def token_type(token: Column) -> Column:
    """The token in lower case without enclosing marks; its final period stays."""
    return F.lower(F.rtrim(F.ltrim(token, F.lit(OPENING)), F.lit(CLOSING)))


def type_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """(type, with_period, without): occurrences of each word type that has a letter."""
    tokens = texts.select(F.explode_outer(T.split_ws(text_col)).alias("token")).where(F.col("token").isNotNull())
    t = tokens.select(token_type(F.col("token")).alias("t"))
    ends = F.endswith("t", F.lit("."))
    word = F.when(ends, F.rtrim(F.col("t"), F.lit("."))).otherwise(F.col("t"))
    rows = t.select(word.alias("type"), ends.alias("ends")).where(F.col("type").rlike("[a-zA-Z]") | (F.lower("type") != F.upper("type")))
    return rows.groupBy("type").agg(F.count_if("ends").alias("with_period"), F.count_if(~F.col("ends")).alias("without"))


def abbreviation_scores(counts: DataFrame) -> DataFrame:
    """``counts`` with ``llr`` and ``score``."""
    total = scalar_row(counts.agg(F.sum("with_period").alias("p"), F.sum(F.col("with_period") + F.col("without")).alias("n")))
    n, p = float(total["n"] or 0), float(total["p"] or 0)
    # an eventless corpus has no ratio: every score is 0
    share = min(max(p / n if n else 0.5, 1e-12), 1 - 1e-12)
    k, m = F.col("with_period"), F.col("without")
    null = k * F.log(F.lit(share)) + m * F.log(F.lit(1 - share))
    other = k * F.log(F.lit(NEARLY_ALWAYS)) + m * F.log(F.lit(1 - NEARLY_ALWAYS))
    letters = F.length(F.replace("type", F.lit("."), F.lit("")))
    inner = F.length("type") - letters
    llr = -2.0 * (null - other)
    return counts.withColumn("llr", llr).withColumn(
        "score", F.when(k > 0, F.col("llr") * F.exp(-letters.cast("double")) * (inner + 1) * F.pow(letters.cast("double"), -m.cast("double"))).otherwise(F.lit(0.0)))


def abbreviations(texts: DataFrame, text_col: str, threshold: float = THRESHOLD) -> DataFrame:
    """(type) of the words that the corpus shows to be abbreviations."""
    return abbreviation_scores(type_counts(texts, text_col)).where(F.col("score") >= threshold).select("type")


def joined_pieces(pieces: Column, goes_on: Column) -> Column:
    """Pieces put together where ``goes_on`` (an array of booleans, one a piece) says the next belongs to it."""
    step = lambda acc, x: F.struct(
        F.when(acc["open"], F.concat(F.slice(acc["done"], 1, F.size(acc["done"]) - 1),
                                     F.array(F.concat_ws(" ", F.element_at(acc["done"], -1), x["piece"]))))
        .otherwise(F.concat(acc["done"], F.array(x["piece"]))).alias("done"), x["goes"].alias("open"))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(False).alias("open"))
    return F.aggregate(F.zip_with(pieces, goes_on, lambda p, g: F.struct(p.alias("piece"), g.alias("goes"))), start, step)["done"]


def last_word(piece: Column) -> Column:
    """The piece's last token without its final period; empty if it ends otherwise."""
    token = token_type(F.regexp_extract(piece, r"(\S+)\s*$", 1))
    return F.when(F.endswith(token, F.lit(".")), F.rtrim(token, F.lit("."))).otherwise(F.lit(""))


def sentences(texts: DataFrame, id_col: str, text_col: str, known: DataFrame, compiled: int = COMPILED) -> DataFrame:
    """(id, sentences): ``known`` (type) are the abbreviations. Up to ``compiled``
    of them stand in the expression; beyond, the words that end pieces are joined with them."""
    pieces = T.raw_sentences(text_col)
    initial = lambda w: (F.length(w) == 1) & (F.lower(w) != F.upper(w))
    words = [r["type"] for r in known.limit(compiled + 1).collect()]
    if len(words) <= compiled:
        goes = lambda p: (last_word(p).isin(*words) if words else F.lit(False)) | initial(last_word(p))
        return texts.select(id_col, joined_pieces(pieces, F.transform(pieces, goes)).alias("sentences"))
    rows = texts.select(id_col, F.posexplode_outer(pieces).alias("at", "piece")).withColumn("type", last_word(F.col("piece")))
    rows = rows.join(known.withColumn("short", F.lit(True)), "type", "left")
    # a text's pieces meet again in one row, as they came
    ordered = F.array_sort(F.collect_list(F.when(F.col("piece").isNotNull(), F.struct(
        "at", "piece", (F.coalesce("short", F.lit(False)) | initial(F.col("type"))).alias("goes")))))
    whole = rows.groupBy(id_col).agg(ordered.alias("t"))
    return whole.select(id_col, joined_pieces(F.col("t.piece"), F.col("t.goes")).alias("sentences"))
