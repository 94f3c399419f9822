"""Boundaries learned from a planted corpus, and prefixes of uneven part files."""

import os

import pytest
from pyspark.sql import functions as F

from quarry.operators import boundaries as B
from quarry.sources import files


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, f"Dr. Who met Mr. J. Smith{i} at noon. They ate fruit, e.g. apples{i}, and left. Did it rain? The end came{i}.") for i in range(60)]
    rows += [(200 + i, f"At noon we left in rain before the end{i} came to all") for i in range(9)]
    rows += [(100, "The end. The rain fell at the end of noon."), (101, None), (102, ""), (103, "No mark"), (104, "He left. She left. The fruit left")]
    return spark.createDataFrame(rows, "pid long, passage string")


def test_abbreviations_are_learned(spark, texts):
    known = {r["type"] for r in B.abbreviations(texts, "passage").collect()}
    assert {"dr", "mr", "j", "e.g"} <= known and not known & {"end", "left", "noon", "rain"}


@pytest.mark.parametrize("compiled", [1000, 0])
def test_abbreviations_and_initials_do_not_split(spark, texts, compiled):
    known = B.abbreviations(texts, "passage")
    got = {r.pid: r.sentences for r in B.sentences(texts, "pid", "passage", known, compiled).collect()}
    assert got[3] == ["Dr. Who met Mr. J. Smith3 at noon.", "They ate fruit, e.g. apples3, and left.", "Did it rain?", "The end came3."]
    assert got[100] == ["The end.", "The rain fell at the end of noon."] and got[104] == ["He left.", "She left.", "The fruit left"]
    assert got[101] == got[102] == [] and got[103] == ["No mark"]
    assert len(got) == texts.count()


def test_no_abbreviation_and_empty_corpus(spark, texts):
    none = texts.where("false")
    assert B.abbreviations(none, "passage").count() == 0 and B.sentences(none, "pid", "passage", B.abbreviations(none, "passage")).count() == 0


def read(spark, names):
    return files.with_file_order(spark.read.schema("a long, b string").option("sep", "\t").csv(names))


@pytest.mark.parametrize("n", [0, 1, 3, 7, 8, 60, 107, 108, 500])
def test_prefix_of_uneven_part_files(spark, tmp_path, n, monkeypatch):
    sizes, a = [3, 0, 4, 1, 100], 0
    for i, size in enumerate(sizes):
        with open(tmp_path / f"part-{i}", "w") as f:
            for _ in range(size):
                f.write(f"{a}\tline {a}\n")
                a += 1
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")  # several blocks in the last file
    opened = []
    try:
        got = files.read_prefix(spark, lambda s, names: opened.extend(names if isinstance(names, list) else []) or read(s, names), str(tmp_path), n)
        assert sorted(r.a for r in got.collect()) == list(range(min(n, a)))
        if n:
            whole = files.first_rows(read(spark, str(tmp_path)), n)
            assert sorted(r.a for r in whole.collect()) == list(range(min(n, a)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    if n <= 3:
        assert not [x for x in opened if os.path.basename(x) in ("part-2", "part-3", "part-4")]  # later files are never read
    assert got.columns == ["a", "b", "ord"]


def test_prefix_of_nothing(spark, tmp_path):
    open(tmp_path / "part-0", "w").close()
    assert files.read_prefix(spark, read, str(tmp_path), 5).count() == 0
    assert [F.col("a")] and files.part_files(spark, str(tmp_path))[0].endswith("part-0")
