"""Corpus cleaning pipeline over the ``documents`` table.

Each stage is f(spark, docs, sf_dir) -> DataFrame; its result is written as
Parquet in the shared checkpoint folder and read back as the next one's input.

quality     documents that the rule ensemble scores below its threshold go
lines       lines with an earlier duplicate go, and documents made of such lines only
near_copies of every group of documents linked by n-gram Jaccard the smallest id stays
benchmark   documents that hold a benchmark item go
pieces      the remaining texts are encoded; their ids decode to the same text

The quality model is fitted, so SQL cannot express the result (ORACLE_SQL is
None); ``tests/llm/test_pipeline.py`` holds the stages against brute force.

Defined results, for every stage unless one is named
* null text: ``quality`` scores it as an empty text; no other stage finds a reason to drop it.
* null id: never dropped by ``lines``, ``near_copies`` or ``benchmark``; its lines are no reference.
* empty text or no words: as null text; nothing is linked with it.
* very long texts: whole, in bounded pieces; a document's shingle set and a text's token ids fit one task.
* ties: by the smallest id, then the first line.
* repeated rows: ``quality``, ``lines``, ``benchmark`` and ``pieces`` decide on every row; rows with one
  id are one document to ``near_copies``, which keeps one row of it (the smallest text, then the row's hash).
* empty table: no rows, the same columns.
* extra columns of any name are kept by all stages but the last, and nulls in them mean nothing.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.llm import edit_decontamination, jaccard_join, line_dedup, piece_lattice, rule_ensemble
from quarry.llm.common import documents, spread, stage
from quarry.sources.tables import read_table


def quality(spark, docs, sf_dir):
    return rule_ensemble.keep_good(spread(docs), read_table(spark, sf_dir, "labels"))


def lines(spark, docs, sf_dir):
    out = line_dedup.clean(spread(docs))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def near_copies(spark, docs, sf_dir):
    groups = jaccard_join.jaccard_components(spread(docs))
    left = docs.join(groups.where("component_id <> doc_id").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
    again = stage(left.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "pipeline-again")
    if not again.limit(1).count():
        return left
    row = F.struct(*left.columns)
    one = (left.join(again, "doc_id", "left_semi").select("doc_id", row.alias("row"), F.coalesce("text", F.lit("")).alias("text"))
           .groupBy("doc_id").agg(F.min_by("row", F.struct("text", F.xxhash64("row"))).alias("row")).select("row.*"))
    return left.join(again, "doc_id", "left_anti").select(*left.columns).unionByName(one)


def benchmark(spark, docs, sf_dir):
    return edit_decontamination.clean(spread(docs), read_table(spark, sf_dir, "benchmark")).select(*docs.columns)


def pieces(spark, docs, sf_dir):
    return piece_lattice.round_trip(spread(docs))


STAGES = [("quality", quality), ("lines", lines), ("near_copies", near_copies), ("benchmark", benchmark), ("pieces", pieces)]
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = documents(spark, sf_dir)
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
