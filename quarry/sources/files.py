"""Readers and writers for the reference's file formats.

Readers (all lazy, schema given, no inference):
* ``read_candidates_tsv``  qid, pid, query, passage - headerless TSV
* ``read_queries_tsv``     qid, query - headerless TSV
* ``read_labelled_tsv``    header row; qid, pid, queries, passage, relevancy
* ``read_text_corpus``     one string per line (tokens never span lines)
* ``read_dense_matrix``    comma-separated floats per line -> array<double>
* ``read_ranking_libsvm``  ``label qid:Q 0:v ...`` lines
Quoting is off everywhere (a leading ``"`` stays part of the field), so an
unbalanced quote cannot swallow the following lines.

File order matters to the reference (prefix truncation, stable ties), so
every row reader adds ``ord`` right at the scan: a struct of the file's path
(shorter names first, so part numbers of any width sort by number), the start
of the block and the row's place in the block. It sorts like the files do,
whatever order Spark reads them in.

Writers:
* ``write_run3``  qid,pid,score CSV, per query by score desc (ties by ord)
* ``write_run6``  qid A pid rank score algoname TSV, rank <= depth
* ``write_matrix`` / ``write_ranking_libsvm`` - feature text files
* ``save_logistic`` / ``load_logistic`` - model parameters as parquet
Sorted output uses a range-partitioned ``orderBy``: part files are in key
order without funnelling the run through one task.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.operators.evaluation import run_rows
from quarry.operators.features import parse_ranking_libsvm, to_ranking_libsvm
from quarry.operators.logistic import LogisticModel
from quarry.operators.ranking import global_rank, score_key
from quarry.plans.execution import ship_package

CANDIDATES_SCHEMA = "qid long, pid long, query string, passage string"
QUERIES_SCHEMA = "qid long, query string"
LABELLED_SCHEMA = "qid long, pid long, queries string, passage string, relevancy double"


def _tsv(spark: SparkSession, path: str, schema: str, header: bool) -> DataFrame:
    return (spark.read.option("sep", "\t").option("header", str(header).lower()).option("quote", "")
            .option("mode", "PERMISSIVE").schema(schema).csv(path))


def with_file_order(df: DataFrame) -> DataFrame:
    """Add ``ord`` to a fresh file scan. A block is read by one task, so the
    increasing id orders its rows; path and block order the blocks."""
    path = F.col("_metadata.file_path")
    return df.select("*", F.struct(F.length(path).alias("size"), path.alias("path"),
                                   F.col("_metadata.file_block_start").alias("start"),
                                   F.monotonically_increasing_id().alias("row")).alias("ord"))


def read_candidates_tsv(spark: SparkSession, path: str) -> DataFrame:
    return with_file_order(_tsv(spark, path, CANDIDATES_SCHEMA, header=False))


def read_queries_tsv(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, QUERIES_SCHEMA, header=False)


def read_labelled_tsv(spark: SparkSession, path: str) -> DataFrame:
    """(qid, pid, query, passage, relevancy, ord); the header names the query column 'queries'."""
    return with_file_order(_tsv(spark, path, LABELLED_SCHEMA, header=True)).withColumnRenamed("queries", "query")


def read_text_corpus(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_dense_matrix(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """(ord, features array<double>) from lines of separated numbers."""
    lines = with_file_order(spark.read.text(path))
    values = F.transform(F.split(F.trim("value"), sep), lambda x: x.cast("double"))
    return lines.select("ord", values.alias("features"))


def read_ranking_libsvm(spark: SparkSession, path: str) -> DataFrame:
    return parse_ranking_libsvm(with_file_order(spark.read.text(path)))


def first_rows(df: DataFrame, n: int, ord_col: str = "ord") -> DataFrame:
    """The first n rows in file order (the reference's ``frame[:n]``), computed
    with a distributed global rank rather than a single-task limit."""
    return global_rank(df, [F.col(ord_col)], "_row").where(F.col("_row") <= n).drop("_row")


def part_files(spark: SparkSession, path: str) -> list[str]:
    """The data files under ``path`` in file order (shorter names first, as in ``ord``)."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath() for f in fs.listStatus(root) if f.isFile()]
    names = [p.toUri().toString() for p in found if not p.getName().startswith(("_", "."))]
    return sorted(names, key=lambda x: (len(x), x))


def read_prefix(spark: SparkSession, read, path: str, n: int) -> DataFrame:
    """The first n rows in file order of ``read(spark, files)``, a reader that adds ``ord``.

    Files are opened in order, twice as many each time, until they hold n rows;
    later files are never read. Of those opened, rows are counted per block; the
    blocks before the one that holds row n are taken whole, and only inside
    that block are rows numbered. Nothing is sorted.
    """
    names, rows, done = part_files(spark, path), 0, 0
    while done < len(names) and rows < n:
        more = names[done:2 * done or 1]
        rows += read(spark, more).count()
        done += len(more)
    if not done:
        return read(spark, path).limit(0)
    df = read(spark, names[:done])
    if rows <= n:
        return df
    block = F.struct("ord.size", "ord.path", "ord.start")
    counts = df.groupBy(block.alias("block")).count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = counts.withColumn("before", before).where(f"before < {n} and before + count >= {n}").first()
    if last is None:
        return df.limit(0)
    end = F.struct(*[F.lit(v).alias(k) for k, v in last["block"].asDict().items()])
    inside = df.where(block == end).withColumn("_row", F.row_number().over(Window.partitionBy(block).orderBy("ord")))
    return df.where(block < end).unionByName(inside.where(F.col("_row") <= n - last["before"]).drop("_row"))


def write_tsv(df: DataFrame, path: str, header: bool = False) -> None:
    """Tab-separated text without quoting; tabs and line ends inside a field become blanks."""
    fields = [F.coalesce(F.translate(F.col(c).cast("string"), "\t\n\r", "   "), F.lit("")) for c in df.columns]
    lines = df.select(F.concat_ws("\t", *fields).alias("value"))
    if not header:
        lines.write.mode("overwrite").text(path)
        return
    # the reader drops the first line of every file, so each file gets one
    names = "\t".join(df.columns)

    def with_header(batches):
        first = True
        for batch in batches:
            rows = batch.column(0).to_pylist()
            yield pa.record_batch([pa.array([names, *rows] if first else rows, pa.string())], names=["value"])
            first = False

    ship_package(df.sparkSession)
    lines.mapInArrow(with_header, "value string").write.mode("overwrite").text(path)


def read_run3(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("qid long, pid long, score double").csv(path)


def read_run6(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "\t").schema(
        "qid long, A string, pid long, rank long, score double, algoname string").csv(path)


def write_run3(scored: DataFrame, path: str) -> None:
    """qid,pid,score without header, rows per query by score desc then ord."""
    (scored.orderBy(F.col("qid"), score_key("score"), F.col("ord"))
     .select("qid", "pid", "score").write.mode("overwrite").csv(path, header=False))


def write_run6(ranked: DataFrame, path: str, algoname: str, depth: int = 100) -> None:
    """qid A pid rank score algoname, tab separated, rank <= depth."""
    rows = run_rows(ranked, algoname, depth)
    rows.orderBy("qid", "rank").write.mode("overwrite").option("sep", "\t").csv(path, header=False)


def write_matrix(df: DataFrame, path: str, col: str = "features") -> None:
    """One line of ``%f``-formatted comma-separated values per row, in ord order."""
    line = F.array_join(F.transform(F.col(col), lambda x: F.format_string("%f", x)), ",")
    df.orderBy("ord").select(line.alias("value")).write.mode("overwrite").text(path)


def write_ranking_libsvm(df: DataFrame, path: str, label: str = "label", qid: str = "qid",
                         features: str = "features") -> None:
    df.orderBy("ord").select(to_ranking_libsvm(df, label, qid, features).alias("value")) \
        .write.mode("overwrite").text(path)


def save_logistic(spark: SparkSession, model: LogisticModel, path: str) -> None:
    spark.createDataFrame([(model.w, model.b, model.learning_rate, model.costs)],
                          "w array<double>, b double, learning_rate double, costs array<double>") \
        .coalesce(1).write.mode("overwrite").parquet(path)


def load_logistic(spark: SparkSession, path: str) -> LogisticModel:
    r = spark.read.parquet(path).first()
    return LogisticModel(list(r["w"]), float(r["b"]), list(r["costs"] or []), float(r["learning_rate"]))
