"""Line dedup by a deletion-neighbourhood join, in DataFrame operations only.

Lines are compared as sequences of lower-cased words. A line is dropped if an
earlier line (by doc_id, then line number) of the corpus has the same words,
or, for lines of ``min_words`` words or more, differs by one word inserted,
deleted or replaced. The earliest stays.

1. ``line_table``: one scan gives every line a 128-bit key, its word count and
   the hashes of its halves. Equal keys are one line; the first occurrence
   stands for it.
2. Two lines one edit apart share a half: the edit cannot fall into both. Only
   lines with a half in common with another line go on (a semi-join that
   loses nothing and leaves a small part of the corpus).
3. ``variants``: for each of those lines, all sequences with one word deleted,
   hashed, with the place of the deletion. Lines are one replacement apart if
   they share a variant at the same place, one insertion apart if a variant
   is the other line. So the earliest neighbour of a line is a minimum over
   its variants' groups: groups of any size meet in grouped minima and no pairs
   of a group are formed.
4. The line found is verified: common prefix plus common suffix of the
   two word sequences must leave at most one word on either side.

Defined results
* null text or null id: the row stays as it is and its lines are no reference.
* blank lines (no word) are never dropped. Empty text: unchanged.
* lines of fewer than ``min_words`` words: dropped only for equal words.
* ties: two places cannot tie; rows that share an id and a line number are the
  same place and keep or lose the line together.
* a line whose earlier neighbour is itself dropped is dropped as well.
* very long lines: a candidate of n words makes n variants, hashed in n steps each.
* extra columns: ``dedup`` reads only id and text; ``clean`` keeps the others.
* empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import rows_with_ids, stage

MIN_WORDS = 5
BROADCAST_IDS = 1_000_000


def normal(line: Column) -> Column:
    """Lower-cased line with its words joined by single blanks."""
    low = F.lower(line)
    messy = F.contains(low, F.lit("  "))
    for c in "\t\x0b\x0c\r":
        messy = messy | F.contains(low, F.lit(c))
    return F.btrim(F.when(messy, F.regexp_replace(low, r"[\x20\x09-\x0D]+", " ")).otherwise(low))


def line_table(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, line_no, k1, k2, halves) of every line with a word."""
    lines = (docs.where("doc_id is not null and text is not null")
             .select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
             .select("doc_id", "line_no", normal(F.col("line")).alias("norm")).where("norm <> ''")
             .withColumn("n", F.length("norm") - F.length(F.replace("norm", F.lit(" "), F.lit(""))) + 1))

    def half(words: str, last: bool) -> str:
        m = f"cast({words} div 2 as int)"
        return f"xxhash64({int(last)}, {words}, substring_index(norm, ' ', {m}{f' - ({words})' if last else ''}))"

    halves = [F.expr(f"case when {w} >= {min_words} then {half(w, last)} end")
              for w in ("n", "(n - 1)") for last in (False, True)]
    return lines.select("doc_id", "line_no", F.xxhash64("norm").alias("k1"), F.xxhash64(F.lit(1), "norm").alias("k2"),
                        *[h.alias(f"h{i}") for i, h in enumerate(halves)])


def candidate_lines(docs: DataFrame, firsts: DataFrame, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """(place, words, h): first occurrences that share a half with another line."""
    keys = firsts.select("k1", "k2", F.explode(F.array_compact(F.array("h0", "h1", "h2", "h3"))).alias("key"))
    shared = keys.groupBy("key").agg((F.min("k1") != F.max("k1")).alias("shared")).where("shared").select("key")
    picked = keys.join(shared, "key").select("k1", "k2").distinct()
    places = stage(firsts.join(picked, ["k1", "k2"]).groupBy(F.col("place.doc_id").alias("doc_id"))
                   .agg(F.collect_list("place.line_no").alias("at")), "line-places")
    rows = rows_with_ids(docs.select("doc_id", "text"), places.select("doc_id"), "doc_id", broadcast_ids)
    return (rows.join(places, "doc_id").withColumn("lines", F.split("text", "\n"))
            .select("doc_id", "lines", F.explode("at").alias("line_no"))
            .select(F.struct("doc_id", "line_no").alias("place"),
                    F.split(normal(F.get("lines", F.col("line_no"))), " ").alias("words"))
            .withColumn("h", F.transform("words", lambda w: F.xxhash64(w))).distinct())


def variants(lines: DataFrame) -> DataFrame:
    """(place, at, v): hash of the line without its word ``at``."""
    return lines.select("place", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.size("h") - 1),
        lambda i: F.xxhash64(F.concat(F.slice("h", F.lit(1), i), F.slice("h", i + 2, F.size("h")))))).alias("at", "v"))


def near_earlier(lines: DataFrame) -> DataFrame:
    """(place, earlier): the earliest line one word edit away, verified."""
    # the lines themselves stand among the variants, at place -1
    rows = stage(variants(lines).union(lines.select("place", F.lit(-1), F.xxhash64("h"))), "line-variants")
    shared = rows.groupBy("v").agg((F.min(F.xxhash64("place")) != F.max(F.xxhash64("place"))).alias("shared")).where("shared")
    rows = stage(rows.join(shared.select("v"), "v"), "line-shared")
    v, base = rows.where("at >= 0"), rows.where("at < 0").select("v", "place")
    replaced = v.groupBy("v", "at").agg(F.min("place").alias("m"), F.max("place").alias("x")).where("m < x")
    longer = v.groupBy("v").agg(F.min("place").alias("m"))
    found = (v.join(replaced, ["v", "at"]).select("place", "m")
             .union(v.join(base.withColumnRenamed("place", "m"), "v").select("place", "m"))
             .union(base.join(longer, "v").select("place", "m")))
    best = found.groupBy("place").agg(F.min("m").alias("earlier")).where("earlier < place")
    pairs = best.join(lines.select("place", F.col("words").alias("a")), "place").join(
        lines.select(F.col("place").alias("earlier"), F.col("words").alias("b")), "earlier")
    return pairs.where(one_edit(F.col("a"), F.col("b"))).select("place", "earlier")


def one_edit(a: Column, b: Column) -> Column:
    """True if two word arrays are at most one word edit apart."""

    def common(x: Column, y: Column) -> Column:
        differ = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), F.lit(False))
        return F.when(differ == 0, F.greatest(F.size(x), F.size(y))).otherwise(differ - 1)

    longest = F.greatest(F.size(a), F.size(b))
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (common(a, b) + common(F.reverse(a), F.reverse(b)) >= longest - 1)


def dropped_lines(docs: DataFrame, min_words: int = MIN_WORDS, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """(doc_id, line_no) of the lines that have an earlier duplicate."""
    lines = stage(line_table(docs, min_words), "line-table")
    firsts = stage(lines.groupBy("k1", "k2").agg(
        F.min(F.struct("doc_id", "line_no")).alias("place"), F.max(F.struct("doc_id", "line_no")).alias("latest"),
        *[F.min(f"h{i}").alias(f"h{i}") for i in range(4)]), "line-firsts")
    again = firsts.where("place < latest").select("k1", "k2", "place")
    copies = (lines.select("doc_id", "line_no", "k1", "k2").join(again, ["k1", "k2"])
              .where(F.struct("doc_id", "line_no") != F.col("place")).select("doc_id", "line_no"))
    near = near_earlier(stage(candidate_lines(docs, firsts, broadcast_ids), "line-candidates"))
    return copies.union(near.select("place.*"))


def _cleaned(docs: DataFrame, min_words: int, broadcast_ids: int) -> DataFrame:
    """(doc_id, row, dropped, lines, kept): the caller's row in one struct, so
    that no name of its columns can meet one of these."""
    gone = dropped_lines(docs.select("doc_id", "text"), min_words, broadcast_ids) \
        .groupBy("doc_id").agg(F.array_sort(F.collect_set("line_no")).alias("dropped"))
    rows = docs.select("doc_id", F.struct(*docs.columns).alias("row"), F.split("text", "\n").alias("lines"))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped")), lambda i: F.get(F.col("lines"), i))
    return rows.join(gone, "doc_id", "left").withColumn(
        "kept", F.when(F.col("dropped").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n")))


def dedup(docs: DataFrame, min_words: int = MIN_WORDS, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, dropped, kept_sha256) for every row of ``docs``."""
    return _cleaned(docs.select("doc_id", "text"), min_words, broadcast_ids).select(
        "doc_id", F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
        F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


def clean(docs: DataFrame, min_words: int = MIN_WORDS, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """``docs`` with the duplicate lines taken out of ``text``; documents that
    lost lines and have no word left go (their lines stand in earlier documents)."""
    out = _cleaned(docs, min_words, broadcast_ids)
    gone = F.col("dropped").isNotNull() & ~F.col("kept").rlike(r"[^\x20\x09-\x0D]")
    return out.where(~gone).select(*[F.col("kept").alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls)))::BIGINT AS line_no FROM d),
w AS (SELECT doc_id, line_no, regexp_extract_all(lower(line), '[^\x20\x09-\x0D]+') AS ws FROM l),
p AS (SELECT (doc_id, line_no) AS place, doc_id, line_no, ws FROM w WHERE len(ws) > 0),
f AS (SELECT ws, min(place) AS place FROM p GROUP BY ws),
v AS (SELECT place, i, ws[:i - 1] || ws[i + 1:] AS v FROM (SELECT place, ws, unnest(range(1, len(ws) + 1)) AS i FROM f WHERE len(ws) >= 5)),
near AS (
  SELECT place, min(m) AS m FROM (
    SELECT place, min(place) OVER (PARTITION BY v, i) AS m FROM v
    UNION ALL SELECT v.place, f.place FROM v JOIN f ON f.ws = v.v WHERE len(f.ws) >= 5
    UNION ALL SELECT f.place, v.place FROM f JOIN v ON f.ws = v.v WHERE len(f.ws) >= 5) GROUP BY place),
gone AS (
  SELECT p.doc_id, p.line_no FROM p JOIN f USING (ws) LEFT JOIN near ON near.place = p.place
  WHERE f.place <> p.place OR near.m < p.place),
g AS (SELECT doc_id, list(DISTINCT line_no ORDER BY line_no) AS dropped FROM gone GROUP BY doc_id)
SELECT documents.doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines,
       coalesce(len(dropped), 0)::BIGINT AS n_dropped, coalesce(dropped, []) AS dropped,
       sha256(CASE WHEN dropped IS NULL THEN coalesce(text, '')
              ELSE array_to_string([x FOR x, k IN string_split(text, chr(10)) IF NOT list_contains(dropped, k - 1)], chr(10)) END) AS kept_sha256
FROM documents LEFT JOIN g USING (doc_id)
"""
