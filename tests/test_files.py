import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.operators.logistic import LogisticModel
from quarry.sources import files


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="quarry-files-")


def test_tsv_readers_keep_quotes_and_order(spark, tmp):
    p = os.path.join(tmp, "cands.tsv")
    with open(p, "w") as fh:
        fh.write('1\t10\t"what is\tthe "start of it\n')
        fh.write("1\t11\twhat is\tsecond passage\n")
        fh.write("2\t10\tother\t\"unbalanced\n")
    df = files.read_candidates_tsv(spark, p).orderBy("ord").collect()
    assert [(r.qid, r.pid) for r in df] == [(1, 10), (1, 11), (2, 10)]
    assert df[0].query == '"what is' and df[2].passage == '"unbalanced'
    assert df[0].ord < df[1].ord < df[2].ord


def test_labelled_header(spark, tmp):
    p = os.path.join(tmp, "val.tsv")
    with open(p, "w") as fh:
        fh.write("qid\tpid\tqueries\tpassage\trelevancy\n5\t7\tq\tp p\t1.0\n")
    r = files.read_labelled_tsv(spark, p).first()
    assert (r.qid, r.pid, r.query, r.passage, r.relevancy) == (5, 7, "q", "p p", 1.0)


def test_matrix_and_libsvm_round_trip(spark, tmp):
    df = spark.createDataFrame([(0, 1.0, 3, [0.5, 1.25]), (1, 0.0, 3, [-2.0, 1e-7])],
                               "ord long, label double, qid long, features array<double>")
    files.write_matrix(df, os.path.join(tmp, "m"))
    back = files.read_dense_matrix(spark, os.path.join(tmp, "m")).orderBy("ord").collect()
    assert [r.features for r in back] == [[0.5, 1.25], [-2.0, 0.0]]   # %f keeps 6 decimals
    files.write_ranking_libsvm(df, os.path.join(tmp, "l"))
    parsed = files.read_ranking_libsvm(spark, os.path.join(tmp, "l")).orderBy("ord").collect()
    assert [(r.label, r.qid, r.features) for r in parsed] == [(1.0, 3, [0.5, 1.25]), (0.0, 3, [-2.0, 1e-7])]


def test_runs_and_prefix(spark, tmp):
    scored = spark.createDataFrame([(1, 10, 0, 0.5), (1, 11, 1, 0.9), (2, 10, 0, 0.1)],
                                   "qid long, pid long, ord long, score double")
    files.write_run3(scored, os.path.join(tmp, "run3"))
    lines = spark.read.csv(os.path.join(tmp, "run3"), schema="qid long, pid long, score double").collect()
    assert sorted((r.qid, r.pid) for r in lines) == [(1, 10), (1, 11), (2, 10)]
    ranked = scored.withColumn("rank", F.lit(1).cast("long"))
    files.write_run6(ranked, os.path.join(tmp, "run6"), "BM25")
    six = spark.read.option("sep", "\t").csv(os.path.join(tmp, "run6")).collect()
    assert len(six) == 3 and six[0][1] == "A1" and six[0][5] == "BM25"
    assert [r.pid for r in files.first_rows(scored, 2).orderBy("ord", "qid").collect()] == [10, 10]


def test_model_save_load(spark, tmp):
    m = LogisticModel([0.1, -0.2], 0.3, [0.69, 0.5], 0.1)
    files.save_logistic(spark, m, os.path.join(tmp, "lr"))
    assert files.load_logistic(spark, os.path.join(tmp, "lr")) == m


def test_order_over_many_uneven_part_files(spark, tmp):
    """Row order comes back whatever the sizes and the order the files are read in."""
    path, want, k = os.path.join(tmp, "parts"), [], 0
    os.mkdir(path)
    for part in range(12):
        with open(os.path.join(path, f"part-{part:05d}-x.txt"), "w") as fh:
            for _ in range((part * 37) % 23 * 40 + 1):
                fh.write(f"{k}.0,{part}.0\n")
                want.append([float(k), float(part)])
                k += 1
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # several blocks a file
    try:
        df = files.read_dense_matrix(spark, path)
        assert [r.features for r in df.orderBy("ord").collect()] == want
        assert [r.features for r in files.first_rows(df, 50).orderBy("ord").collect()] == want[:50]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_queries_and_text_corpus(spark, tmp):
    with open(os.path.join(tmp, "q.tsv"), "w") as fh:
        fh.write("3\twhat \"is\n4\tthat\n")
    assert [tuple(r) for r in files.read_queries_tsv(spark, os.path.join(tmp, "q.tsv")).collect()] == [(3, 'what "is'), (4, "that")]
    with open(os.path.join(tmp, "t.txt"), "w") as fh:
        fh.write("a b\n\nc")
    assert [r.value for r in files.read_text_corpus(spark, os.path.join(tmp, "t.txt")).collect()] == ["a b", "", "c"]


def test_headed_tsv_of_several_files(spark, tmp):
    df = spark.createDataFrame([(i, i + 1, 'q "x', "p\tp\np", float(i % 2)) for i in range(20)],
                               "qid long, pid long, queries string, passage string, relevancy double").repartition(4)
    files.write_tsv(df, os.path.join(tmp, "h"), header=True)
    back = sorted(tuple(r)[:5] for r in files.read_labelled_tsv(spark, os.path.join(tmp, "h")).collect())
    assert back == [(i, i + 1, 'q "x', "p p p", float(i % 2)) for i in range(20)]
