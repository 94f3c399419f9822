import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="quarry-test-ckpt-")
    s = (SparkSession.builder.master("local[4]").appName("quarry-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(ckpt)  # only where the session leaves it unset
    yield s
    s.stop()


@pytest.fixture(scope="session")
def golden(spark):
    """Four passages and one query from FIXTURES.md section 4."""
    from quarry.operators.scoring import Retrieval
    from quarry.sources.passage_index import PassageIndex

    passages = spark.createDataFrame(
        [(1, "the red fox", 1), (2, "Red red dog.", 2), (3, "blue sky  day", 3), (4, "the old crow", 4)],
        "pid long, passage string, ord long")
    queries = spark.createDataFrame([(1, "red fox fox day")], "qid long, query string")
    cands = spark.createDataFrame([(1, p, p) for p in (1, 2, 3, 4)], "qid long, pid long, ord long")
    idx = PassageIndex.build(passages, os.path.join(tempfile.mkdtemp(prefix="quarry-golden-"), "idx"))
    return Retrieval(idx, queries, cands)
