import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def small(spark):
    """documents of the smallest fixture as (doc_id, text), by id."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    return sorted((r[0], r[1]) for r in rows)
