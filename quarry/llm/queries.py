"""Registered queries of the training-data operators: f(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.llm import edit_decontamination, jaccard_join, language_mixture, license_scan, line_dedup, lz_dedup, piece_lattice, prefix_trie, quality_rules, revisit_resolution, rule_ensemble, set_sketch, token_alignment
from quarry.llm.common import documents, spread
from quarry.sources.tables import read_table


def op1_edit_decontamination(spark, sf_dir):
    docs = spread(documents(spark, sf_dir).select("doc_id", "text"))
    return edit_decontamination.leaks(docs, read_table(spark, sf_dir, "benchmark"))


def op2_line_dedup(spark, sf_dir):
    return line_dedup.dedup(spread(documents(spark, sf_dir).select("doc_id", "text")))


def op3_revisit_resolution(spark, sf_dir):
    records = revisit_resolution.capture_records(spread(read_table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return revisit_resolution.resolve(records).select(
        "revisit_id", "url_key", "time", "response_id", "status", F.array_join(lines, "|").alias("headers"), "digest")


def op4_rule_ensemble(spark, sf_dir):
    docs = spread(documents(spark, sf_dir).select("doc_id", "text"))
    return rule_ensemble.classify(docs, read_table(spark, sf_dir, "labels"))


def op5_lz_dedup(spark, sf_dir):
    return lz_dedup.dedup(spread(documents(spark, sf_dir).select("doc_id", "text")))


def op6_license_scan(spark, sf_dir):
    return license_scan.scan(spread(documents(spark, sf_dir).select("doc_id", "text")))


def op7_piece_lattice(spark, sf_dir):
    return piece_lattice.round_trip(spread(documents(spark, sf_dir).select("doc_id", "text")))


def op8_language_mixture(spark, sf_dir):
    docs = spread(documents(spark, sf_dir).select("doc_id", "text", "lang"))
    return language_mixture.identify(docs, language_mixture.learn(docs))


def op9_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_components(spread(documents(spark, sf_dir).select("doc_id", "text")))


def op10_quality_rules(spark, sf_dir):
    return quality_rules.apply_rules(spread(documents(spark, sf_dir).select("doc_id", "text")))


def op11_set_sketch(spark, sf_dir):
    return set_sketch.near_duplicates(spread(documents(spark, sf_dir).select("doc_id", "text")))


def op12_token_alignment(spark, sf_dir):
    return token_alignment.align_corpus(spread(documents(spark, sf_dir).select("doc_id", "text")))


def op13_prefix_trie(spark, sf_dir):
    turns = prefix_trie.numbered_turns(spread(read_table(spark, sf_dir, "conversations")))
    return prefix_trie.prefix_trie(prefix_trie.rebuild(turns))


QUERIES = {
    "op1_edit_decontamination": op1_edit_decontamination,
    "op2_line_dedup": op2_line_dedup,
    "op3_revisit_resolution": op3_revisit_resolution,
    "op4_rule_ensemble": op4_rule_ensemble,
    "op5_lz_dedup": op5_lz_dedup,
    "op6_license_scan": op6_license_scan,
    "op7_piece_lattice": op7_piece_lattice,
    "op8_language_mixture": op8_language_mixture,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_quality_rules": op10_quality_rules,
    "op11_set_sketch": op11_set_sketch,
    "op12_token_alignment": op12_token_alignment,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE = {
    "op2_line_dedup": line_dedup.ORACLE_SQL,
    "op3_revisit_resolution": revisit_resolution.ORACLE_SQL,
    "op10_quality_rules": quality_rules.ORACLE_SQL,
}
