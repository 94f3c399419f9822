"""Relations built from the fixture tables.

The retrieval data model is (queries, passages, candidates, labels). The
fixture supplies them as parquet tables:

* passages   <- documents  (doc_id -> pid, text -> passage, ord = pid)
* queries    <- benchmark  (item_id -> qid, text -> query)
* quality    <- labels     (doc_id -> pid, quality, toxic)
* html pages <- pages      (page_id, html)
* vectors    <- embeddings (vec_id, embedding, label)

Only the columns a query needs are selected, so the parquet scan reads just
those (``ReadSchema`` in the plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a text table over the cluster when its scan has fewer
    partitions than cores (a file with one row group is read by one task).
    Large inputs already arrive in many splits and pass through unchanged."""
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pid, passage, ord); ord is the reference's file order, here the pid."""
    return spread(read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("pid"),
        F.col("text").alias("passage"),
        F.col("doc_id").alias("ord"),
    ))


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(qid, query)."""
    return read_table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("qid"), F.col("text").alias("query"))


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pid, quality, toxic)."""
    return read_table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("pid"), "quality", "toxic")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read_table(spark, sf_dir, "pages").select("page_id", "html"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
