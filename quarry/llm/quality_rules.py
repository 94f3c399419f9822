"""Quality rules: a threshold table compiled into one Spark projection.

``METRICS`` names length, symbol, stop-word, repetition and line statistics
as SQL column expressions over a text; ``RULES`` is the threshold table (metric, comparison,
bound). ``apply_rules`` compiles the table into a single projection without
user functions: one pass over the rows, no shuffle, whatever the sizes.

Defined results
* null text: as the empty text: no words, all counts 0, ``base_failed`` true.
* null ids, repeated rows and ties: every input row gives one output row.
* very long texts: repeats are found by sorting hashes inside the row, so a
  row costs n log n in its own length.
* extra columns: only the id and text columns are read, so clashes cannot occur.
* empty table: no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import count_chars, word_array

SYMBOLS = "#*$%&|<>"
# Frequent function words of the languages served.
STOP_WORDS = {
    "en": ["the", "be", "to", "of", "and", "that", "have", "with", "in", "is", "a", "for", "on", "are", "was", "it"],
    "fr": ["le", "la", "les", "de", "des", "et", "est", "un", "une", "en", "que", "dans", "sur", "pour", "qui", "au"],
    "de": ["der", "die", "das", "und", "ist", "ein", "eine", "mit", "von", "den", "im", "zu", "nicht", "als", "auf"],
    "es": ["el", "los", "las", "y", "del", "que", "en", "un", "una", "por", "con", "se", "no", "es", "lo", "al"],
}


@dataclass(frozen=True)
class Rule:
    """A row of the threshold table; a document must satisfy it to be kept."""

    name: str
    metric: str
    op: str
    bound: float


#: Rules that the base verdict already holds.
BASE_MIN_WORDS = 50
BASE_MAX_REPEAT_PERCENT = 50

RULES = (
    Rule("too_long", "n_words", "<=", 100_000),
    Rule("short_words", "mean_word_chars", ">=", 2.0),
    Rule("long_words", "mean_word_chars", "<=", 12.0),
    Rule("symbols", "symbols_per_word", "<=", 0.1),
    Rule("stop_words", "n_stop_words", ">=", 2),
    Rule("duplicate_lines", "dup_line_ratio", "<=", 0.5),
    Rule("bullet_lines", "bullet_line_ratio", "<=", 0.9),
    Rule("ellipsis_lines", "ellipsis_line_ratio", "<=", 0.3),
)


def _ratio(num: str, den: str) -> Column:
    return F.when(F.col(den) > 0, F.col(num) / F.col(den)).otherwise(F.lit(0.0))


def repeated_words(words: Column, grams: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more.

    The window hashes are sorted with their positions; equal neighbours are
    repeats. Their positions, sorted again, cover min(3, gap) new words each.
    """
    keyed = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

    def covered(s: Column) -> Column:
        same = F.filter(s, lambda x, j: F.coalesce(x["g"] == F.get(s, j - 1)["g"], F.lit(False))
                        | F.coalesce(x["g"] == F.get(s, j + 1)["g"], F.lit(False)))
        places = F.array_sort(F.transform(same, lambda x: x["i"]))
        start = F.struct(F.lit(0).cast("int").alias("n"), F.lit(-3).cast("int").alias("last"))
        return F.aggregate(
            places, start,
            lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).cast("int").alias("n"),
                                  p.cast("int").alias("last")),
            lambda a: a["n"].cast("long"))

    # a one-element transform binds the sorted array once
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0).cast("long")).otherwise(
        F.transform(F.array(keyed), covered)[0])


def metrics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col`` and the statistics the rules use."""
    stops = F.array(*[F.lit(w) for w in sorted({w for ws in STOP_WORDS.values() for w in ws})])
    t = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    t = t.select("doc_id", "t", word_array(F.col("t")).alias("w"),
                 F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != "").alias("lines"))
    t = t.withColumn("grams", F.when(F.size("w") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("w") - 3),
        lambda i: F.xxhash64(F.get(F.col("w"), i), F.get(F.col("w"), i + 1), F.get(F.col("w"), i + 2)))
    ).otherwise(F.array().cast("array<bigint>")))
    t = t.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.translate("t", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        count_chars(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w"), F.col("grams")).alias("n_repeat_words"),
        F.size(F.array_intersect("w", stops)).cast("long").alias("n_stop_words"),
        F.size(F.filter("lines", lambda x: F.ltrim(x).substr(1, 1).isin("-", "*", "•"))).cast("long").alias("n_bullets"),
        F.size(F.filter("lines", lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))).cast("long").alias("n_ellipsis"),
    )
    return t.select(
        "*",
        _ratio("word_chars", "n_words").alias("mean_word_chars"),
        _ratio("n_symbols", "n_words").alias("symbols_per_word"),
        _ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        _ratio("n_bullets", "n_lines").alias("bullet_line_ratio"),
        _ratio("n_ellipsis", "n_lines").alias("ellipsis_line_ratio"),
    )


def compiled(rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules a row breaks, in table order, as one array column."""
    broken = []
    for r in rules:
        m = F.col(r.metric)
        holds = {"<=": m <= r.bound, ">=": m >= r.bound, "<": m < r.bound, ">": m > r.bound}[r.op]
        broken.append(F.when(~holds, F.lit(r.name)))
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


def apply_rules(df: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Statistics, verdicts and broken rules of every row of ``df``."""
    m = metrics(df, id_col, text_col).withColumn(
        "base_failed", (F.col("n_words") < BASE_MIN_WORDS)
        | (100 * F.col("n_repeat_words") > BASE_MAX_REPEAT_PERCENT * F.col("n_words")))
    return m.withColumn("broken", compiled(rules)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept"),
        F.concat_ws(",", "broken").alias("broken_rules"), "n_stop_words")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls
  FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM d WHERE len(w) >= 3),
dup AS (SELECT doc_id, p FROM p
        QUALIFY count(*) OVER (PARTITION BY doc_id, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2]) > 1),
rep AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM dup) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         len(list_intersect(list_distinct(w), [@STOPS@]))::BIGINT AS n_stop_words,
         len(ls) AS n_lines,
         len([x FOR x IN ls IF ltrim(x, ' ')[1] IN ('-', '*', '•')]) AS n_bullets,
         len([x FOR x IN ls IF rtrim(x, ' ') LIKE '%...' OR rtrim(x, ' ') LIKE '%…']) AS n_ellipsis
  FROM d LEFT JOIN rep USING (doc_id)),
v AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    [x FOR x IN [
      CASE WHEN n_words > 100000 THEN 'too_long' END,
      CASE WHEN (CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END) < 2.0 THEN 'short_words' END,
      CASE WHEN (CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END) > 12.0 THEN 'long_words' END,
      CASE WHEN n_words > 0 AND n_symbols / n_words > 0.1 THEN 'symbols' END,
      CASE WHEN n_stop_words < 2 THEN 'stop_words' END,
      CASE WHEN n_lines > 0 AND n_dup_lines / n_lines > 0.5 THEN 'duplicate_lines' END,
      CASE WHEN n_lines > 0 AND n_bullets / n_lines > 0.9 THEN 'bullet_lines' END,
      CASE WHEN n_lines > 0 AND n_ellipsis / n_lines > 0.3 THEN 'ellipsis_lines' END] IF x IS NOT NULL] AS broken
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND len(broken) = 0 AS kept, array_to_string(broken, ',') AS broken_rules, n_stop_words
FROM v
""".replace("@STOPS@", ", ".join(f"'{w}'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws})))
