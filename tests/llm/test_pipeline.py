"""The pipeline's stages against brute-force versions, each on its own input."""

from helpers import EDGE, edge
from test_dedup import brute_jaccard, brute_leaks, brute_lines

import __spark_entry__ as entry
import corpus_pipeline as cp
from quarry.llm import edit_decontamination as decon
from quarry.llm import piece_lattice, rule_ensemble

SF = "/root/testdata/sf0.001"


def texts(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = cp.quality(spark, docs, SF).cache()
    verdict = {r.doc_id: r.predicted for r in rule_ensemble.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert sorted(r.doc_id for r in good.collect()) == sorted(i for i, p in verdict.items() if p)
    lined = cp.lines(spark, good, SF).cache()
    gone = brute_lines(texts(good))
    want = []
    for i, t in texts(good):
        kept = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(i, []))
        if kept.strip() or i not in gone:
            want.append((i, kept))
    assert texts(lined) == want
    single = cp.near_copies(spark, lined, SF).cache()
    groups = brute_jaccard(want)
    want = [(i, t) for i, t in want if groups[i][1] == i]
    assert texts(single) == want
    clean = cp.benchmark(spark, single, SF).cache()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {r.doc_id for r in clean.collect()}
    assert left == {i for i, _ in want} - {d for d, _ in brute_leaks(want, items, decon.EDIT_RATE)}
    out = cp.pieces(spark, clean, SF).collect()
    assert all(r.exact for r in out) and sorted(r.doc_id for r in out) == sorted(left)
    for df in (good, lined, single, clean):
        assert df.columns == docs.columns


def test_run_matches_brute_force_with_planted_leaks(spark, tmp_path):
    sf = str(tmp_path)
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{sf}/{name}.parquet")
    items = sorted((r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect())
    source = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted(source.collect(), key=lambda r: r.doc_id)[:120]
    planted = {rows[k].doc_id: items[k % len(items)][1] for k in range(10, 40)}
    rows = [(*(f"{v}\n{planted[r.doc_id]}" if c == "text" and r.doc_id in planted else v for c, v in r.asDict().items()),) for r in rows]
    spark.createDataFrame(rows, source.schema).write.parquet(f"{sf}/documents.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = {r.doc_id: r for r in cp.run(spark, sf).collect()}

    good = {r.doc_id for r in rule_ensemble.classify(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect() if r.predicted}
    want = [(i, t) for i, t in texts(docs) if i in good]
    gone = brute_lines(want)
    lined = [(i, "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(i, []))) for i, t in want]
    want = [(i, t) for i, t in lined if t.strip() or i not in gone]
    groups = brute_jaccard(want)
    want = [(i, t) for i, t in want if groups[i][1] == i]
    dirty = {d for d, _ in brute_leaks(want, items, decon.EDIT_RATE)}
    assert len(dirty & planted.keys()) > 3 and len(want) - len(dirty) > 10
    assert out.keys() == {i for i, _ in want} - dirty
    spelled = piece_lattice.PieceTable.load().spelled()
    for i, t in want:
        if i in out:
            assert b"".join(spelled[k] for k in out[i].ids).decode()[1:] == t and out[i].exact


def test_stages_keep_edge_rows(spark):
    rows = edge(spark, extra=True).selectExpr("*", "'en' lang", "'s' source", "cast(length(text) as bigint) n_chars")
    columns = rows.columns
    for step in (cp.lines, cp.near_copies, cp.benchmark):
        rows = step(spark, rows, SF)
        assert rows.columns == columns
    # 5 has a copy in 6; the rows of 6 are one document
    assert sorted(str(r.doc_id) for r in rows.collect()) == ["1", "2", "3", "4", "5", "7", "8", "None"]
    assert all(r.label == r.token == r["lines__"] == "z" for r in rows.collect())


def test_quality_and_pieces_on_edge_rows_and_empty_tables(spark):
    rows = edge(spark, extra=True).selectExpr("*", "'en' lang", "'s' source", "cast(length(text) as bigint) n_chars")
    verdict = rule_ensemble.classify(rows, spark.read.parquet(f"{SF}/labels.parquet")).collect()
    good = cp.quality(spark, rows, SF)
    assert good.columns == rows.columns
    assert sorted(str(r.doc_id) for r in good.collect()) == sorted(str(r.doc_id) for r in verdict if r.predicted)
    out = cp.pieces(spark, rows, SF).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in EDGE) and all(r.exact for r in out)
    empty = rows.where("false")
    for name, step in cp.STAGES:
        assert step(spark, empty, SF).count() == 0, name


def test_rows_of_one_id_are_one_document_to_near_copies(spark):
    rows = [(3, "some other text that stands alone", "x"), (3, "a text which is the smaller one", "y"), (3, "a text which is the smaller one", "y"), (4, None, None)]
    out = cp.near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string, row string"), SF).collect()
    assert sorted(map(tuple, out)) == [(3, "a text which is the smaller one", "y"), (4, None, None)]


def test_queries_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
