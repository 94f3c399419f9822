"""Helpers shared by the training-data operators.

``words_of`` tokenises and hashes a batch of texts with NumPy, so the Python
workers never loop over single words. ``stage`` writes an intermediate table
to the shared folder named by ``spark.checkpoint.dir``: lineage is cut, lost
executors cost only their running tasks, and the table goes when the
application ends.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.plans.execution import ensure_checkpoint_dir, ship_package
from quarry.sources.tables import read_table

U64 = np.uint64
_MULT = U64(0x9E3779B97F4A7C15 | 1)
_INV = U64(pow(int(_MULT), -1, 1 << 64))
# Bytes hashed at a time; bounds the memory of a Python worker.
CHUNK_BYTES = 1 << 20
# Texts taken from an Arrow batch at a time (bytes).
GROUP_BYTES = 4 << 20


def separators(word_bytes: str) -> np.ndarray:
    """Boolean table over byte values: True where a byte ends a word.

    ``space``: 0x20 and 0x09-0x0D. ``alnum``: every byte below 0x80 that is
    not 0-9 or a-z (the text is lower-cased first).
    """
    table = np.zeros(256, dtype=bool)
    if word_bytes == "space":
        table[[0x20, *range(0x09, 0x0E)]] = True
    elif word_bytes == "alnum":
        table[:0x80] = True
        table[0x30:0x3A] = False
        table[0x61:0x7B] = False
    else:
        raise ValueError(f"unknown word class {word_bytes!r}")
    return table


SPACE = separators("space")
ALNUM = separators("alnum")


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_POW: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(M^0..M^n, M^-0..M^-n) modulo 2^64."""
    have = _POW.get("m")
    if have is None or len(have) <= n:
        size = max(n + 1, CHUNK_BYTES + 1)
        for key, base in (("m", _MULT), ("i", _INV)):
            p = np.full(size, base, dtype=U64)
            p[0] = 1
            _POW[key] = np.cumprod(p, dtype=U64)
    return _POW["m"], _POW["i"]


@dataclass
class Words:
    """Words of a group of texts: hash, byte start and end in ``data``;
    words of text i are ``first[i]:first[i + 1]``."""

    data: bytes
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def bytes_of(self, a: int, b: int) -> list[bytes]:
        return [self.data[s:e] for s, e in zip(self.start[a:b].tolist(), self.end[a:b].tolist(), strict=True)]


def words_of(texts: list[str | None], seps: np.ndarray = SPACE, lower: bool = False) -> Words:
    """Tokenise and hash ``texts`` (None counts as empty)."""
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    if lower:
        raw = [r.lower() for r in raw]  # bytes.lower touches A-Z only
    data = b" ".join(raw) + b" "
    offsets = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=offsets[1:])
    buf = np.frombuffer(data, dtype=np.uint8)
    sep = seps[buf]
    edge = np.flatnonzero(sep[1:] != sep[:-1]) + 1
    if len(buf) and not sep[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[0::2], edge[1::2]
    hashes = np.empty(len(start), dtype=U64)
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + CHUNK_BYTES, "right")))
        a, b = int(start[lo]), int(end[hi - 1])
        up, down = powers(b - a)
        acc = np.zeros(b - a + 1, dtype=U64)
        np.cumsum((buf[a:b].astype(U64) + U64(1)) * up[:b - a], out=acc[1:])
        s, e = start[lo:hi] - a, end[lo:hi] - a
        hashes[lo:hi] = mix((acc[e] - acc[s]) * down[s] + (e - s).astype(U64) * U64(0xD6E8FEB86659FD93))
        lo = hi
    return Words(data, hashes, start, end, np.searchsorted(start, offsets))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, dtype=U64)
    up, _ = powers(width)
    out = np.zeros(n, dtype=U64)
    for j in range(width):
        out += hashes[j:j + n] * up[width - j]
    return mix(out)


def groups(texts: list[str | None], limit: int = GROUP_BYTES):
    """Slices of ``texts`` of about ``limit`` bytes, one text at least."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "") + 1
        if size >= limit:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def text_groups(column: pa.Array, limit: int):
    """(first row, texts) for slices of about ``limit`` bytes of a string column,
    one text at least; only one slice at a time is turned into Python strings."""
    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    lo = 0
    while lo < len(column):
        done = size[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(size, done + limit, "right")))
        yield lo, column.slice(lo, hi - lo).to_pylist()
        lo = hi


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def spread(df: DataFrame) -> DataFrame:
    """Give a scan that has fewer splits than the cluster has cores one split per core."""
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def prepared(df: DataFrame) -> DataFrame:
    """Make the package importable in the Python workers of ``df``'s session."""
    ship_package(df.sparkSession)
    return df


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents whose labels must not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def word_array(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` as an array, JVM-side; null gives none."""
    blanks = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.array_remove(F.split(blanks, " "), "")


def count_chars(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): one row (node,
    component) per node, component = smallest node reachable.

    Each round hangs every node and its neighbours under the smallest of
    them (large star, then small star), which halves long chains, so the
    number of rounds grows with the logarithm of the component's diameter.
    Every step is a grouped minimum or a join; no group is collected.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    e = stage(e, "edges")
    while True:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: neighbours above a node go to the smallest around it
        large = (both.join(low, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        # small star: a node and its neighbours below go to the smallest of those
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b")))).where("a <> b").distinct()
        small = stage(small, "edges")
        # done when every node hangs under one node that hangs under none
        many = small.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
        deep = 0 if many else small.alias("x").join(
            small.select(F.col("a").alias("b")).alias("y"), "b", "left_semi").limit(1).count()
        if not many and not deep:
            roots = small.select(F.col("b").alias("node")).distinct()
            return (small.select(F.col("a").alias("node"), F.col("b").alias("component"))
                    .union(roots.select("node", F.col("node").alias("component"))))
        e = small


def rows_with_ids(df: DataFrame, ids: DataFrame, key: str, broadcast_ids: int = 1_000_000) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``ids``. The ids are counted first and
    broadcast only up to ``broadcast_ids`` (8 bytes each); beyond, the join is
    shuffled. Both ways give the same rows."""
    small = ids.limit(broadcast_ids + 1).count() <= broadcast_ids
    return df.join(F.broadcast(ids) if small else ids, key, "left_semi")
