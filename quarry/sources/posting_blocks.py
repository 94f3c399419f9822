"""Posting lists as blocks: one row per (term, run of up to ``BLOCK`` postings).

    term, first_pid, last_pid, n, max_count, min_len, sum_count, data

``data`` holds, as variable-length integers of seven bits a byte, the steps
between the run's passage ids, then its term counts, then its passage lengths.
The other columns answer questions without decoding: which ids a block can
hold, how many postings it has, and how large a term count and how short a
passage may be in it (an upper bound of any score that grows with the count and
falls with the length). ``first_pid`` names a block of its term.

Encoding and decoding are array passes over Arrow batches; a block is decoded
by the task that reads it. Ids are integers; counts and lengths are not negative.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.plans.execution import ship_package

BLOCK = 128
SCHEMA = "term string, first_pid long, last_pid long, n int, max_count int, min_len int, sum_count long, data binary"
#: Blocks decoded at a time.
BLOCKS_AT_ONCE = 4096


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offset of each value and the end): seven bits a byte, low first,
    the high bit set on all but a value's last byte."""
    v = values.astype(np.uint64)
    size = np.ones(len(v), np.int64)
    for k in range(1, 10):
        size += v >= np.uint64(1 << 7 * k)
    at = np.concatenate(([0], np.cumsum(size)))
    out = np.empty(int(at[-1]), np.uint8)
    for k in range(int(size.max(initial=0))):
        has = size > k
        byte = ((v[has] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8)
        out[at[:-1][has] + k] = byte | ((size[has] > k + 1).astype(np.uint8) << 7)
    return out, at


def from_varints(data: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(data < 128)
    start = np.concatenate(([0], last[:-1] + 1)) if len(last) else last
    size = last - start + 1
    out = np.zeros(len(last), np.uint64)
    for k in range(int(size.max(initial=0))):
        has = size > k
        out[has] |= (data[start[has] + k].astype(np.uint64) & np.uint64(127)) << np.uint64(7 * k)
    return out.astype(np.int64)


def _block_rows(rows: pa.RecordBatch, start: np.ndarray) -> pa.RecordBatch:
    """The blocks of ``rows`` (term, pid, count, len) that begin at ``start``."""
    pid, count, length = (rows[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("pid", "count", "len"))
    end = np.concatenate((start[1:], [len(pid)]))
    n = end - start
    step = np.diff(pid, prepend=pid[:1])
    step[start] = 0
    at = np.arange(len(pid)) - np.repeat(start, n)  # place in the block
    base = np.repeat(3 * start, n) + at
    flat, wide = np.empty(3 * len(pid), np.int64), np.repeat(n, n)
    flat[base], flat[base + wide], flat[base + 2 * wide] = step, count, length
    data, offsets = varints(flat)
    edge = offsets[np.concatenate((3 * start, [3 * len(pid)]))]
    packed = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(edge.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
    return pa.record_batch(
        [rows["term"].take(pa.array(start)), pa.array(pid[start]), pa.array(pid[end - 1]), pa.array(n.astype(np.int32)),
         pa.array(np.maximum.reduceat(count, start).astype(np.int32)), pa.array(np.minimum.reduceat(length, start).astype(np.int32)),
         pa.array(np.add.reduceat(count, start)), packed],
        names=["term", "first_pid", "last_pid", "n", "max_count", "min_len", "sum_count", "data"])


def encode_batches(batches: Iterator[pa.RecordBatch], block: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Blocks of rows sorted by (term, pid); a block may go on from one batch into the next."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        term = batch["term"]
        new = np.ones(batch.num_rows, bool)
        new[1:] = pc.not_equal(term.slice(1), term.slice(0, len(term) - 1)).to_numpy(zero_copy_only=False)
        runs = np.flatnonzero(new)
        place = np.arange(batch.num_rows) - np.repeat(runs, np.diff(np.concatenate((runs, [batch.num_rows]))))
        start = np.flatnonzero(place % block == 0)
        held = batch.slice(int(start[-1]))  # the last block may be incomplete
        if len(start) > 1:
            yield _block_rows(batch.slice(0, int(start[-1])), start[:-1])
    if held is not None and held.num_rows:
        yield _block_rows(held, np.array([0]))


def encode(postings: DataFrame, count: str, length: str, block: int = BLOCK) -> DataFrame:
    """Blocks of ``postings`` (term, pid, ``count``, ``length``), whose partitions are sorted by (term, pid)."""
    ship_package(postings.sparkSession)
    rows = postings.select("term", F.col("pid").cast("long").alias("pid"), F.col(count).alias("count"), F.col(length).alias("len"))
    return rows.mapInArrow(lambda batches: encode_batches(batches, block), SCHEMA)


def _decoded(blocks: pa.RecordBatch) -> pa.RecordBatch:
    n = blocks["n"].to_numpy(zero_copy_only=False).astype(np.int64)
    data = blocks["data"]
    offsets = np.frombuffer(data.buffers()[1], np.int32, len(data) + 1, data.offset * 4)
    flat = from_varints(np.frombuffer(data.buffers()[2], np.uint8, int(offsets[-1] - offsets[0]), int(offsets[0])))
    start = np.concatenate(([0], np.cumsum(n)))[:-1]
    at = np.arange(int(n.sum())) - np.repeat(start, n)
    base, wide = np.repeat(3 * start, n) + at, np.repeat(n, n)
    steps = np.cumsum(flat[base])
    pid = steps - np.repeat(steps[start], n) + np.repeat(blocks["first_pid"].to_numpy(zero_copy_only=False), n)
    term = blocks["term"].take(pa.array(np.repeat(np.arange(len(n)), n)))
    return pa.record_batch([term, pa.array(pid), pa.array(flat[base + wide]), pa.array(flat[base + 2 * wide])], names=["term", "pid", "count", "len"])


def decode(blocks: DataFrame, count: str, length: str) -> DataFrame:
    """(term, pid, ``count`` long, ``length`` int): the postings of ``blocks``."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCKS_AT_ONCE):
                yield _decoded(batch.slice(lo, BLOCKS_AT_ONCE))

    ship_package(blocks.sparkSession)
    rows = blocks.select("term", "first_pid", "n", "data").mapInArrow(run, "term string, pid long, count long, len long")
    return rows.select("term", "pid", F.col("count").alias(count), F.col("len").cast("int").alias(length))
