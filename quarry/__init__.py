"""quarry: passage retrieval and learning-to-rank as Spark DataFrame jobs.

Layout
------
functions/  Column expressions: analyzers, HTML stripping, numeric helpers.
sources/    Readers for the fixture tables and the TSV / matrix / ranking-LibSVM
            formats, plus the run-file and feature sinks.
operators/  Index statistics, scorers, ranking, evaluation, features, learners.
plans/      End-to-end compositions (unsupervised ranking, labelled
            evaluation, learned ranking) and durability helpers.
streaming/  Scoring query micro-batches against a persisted index.
"""

__all__ = ["session"]
