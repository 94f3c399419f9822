"""Substring dedup by equal blocks and a window join, in place of a greedy
relative Lempel-Ziv parse: no match is extended to a longest factor.

Every document's copied windows are found in the text of documents with
smaller ids. The reference is indexed by content-defined blocks: of the 16-word
runs inside a 50-word window the one with the smallest hash is the window's
anchor, so equal windows have equal anchors wherever they stand. Consecutive
windows with one anchor form a block; blocks cover all windows of a document
and number about one for twenty words.

1. ``blocks`` cuts every text into blocks (anchor hash, hash of the block's
   whole word sequence).
2. The first document of every distinct block is its reference. A later
   document's equal block is a factor copied whole: all its windows start in
   the reference.
3. Factor boundaries: where a copy begins or ends inside a block, the block
   differs but its anchor is shared. Only such blocks - the first occurrence
   of each distinct block under an anchor that has several - are checked
   window by window, against the windows of all other blocks of that anchor.

The union of both gives exactly the windows whose word sequence also starts
in a document with a smaller id. Copies meet in grouped minima, so a group of
thousands of copies costs its number of blocks, not its pairs; checked
windows belong to distinct blocks only.

Defined results
* null text: no words, nothing removed. Empty text likewise.
* null id: never a reference and nothing removed from it.
* rows that share an id: each is parsed on its own and neither is a reference
  of the other (the ids are not smaller).
* texts of fewer than 50 words have no window. Repeats inside one document
  stay unless they also start in a smaller one.
* very long texts: hashing works on bounded pieces; a document's spans are
  held by the task that cuts it.
* extra columns: only id and text are read. Empty table: no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import U64, groups, mix, powers, prepared, rolling, stage, words_of

WINDOW = 50
ANCHOR = 16
SECOND = 0x5851F42D4C957F2D  # salt of the second window hash

BLOCK = "doc_id long, text_key long, first long, last long, anchor long, block long"
PROBE = "doc_id long, text_key long, at long, key long, key2 long"
OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<first:long,last:long>>"


def argmin_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest value (the leftmost of equals) in every run of ``width``."""
    n = len(values) - width + 1
    best, reach = np.arange(len(values)), 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = best[:len(best) - step], best[step:]
        best = np.where(values[left] <= values[right], left, right)
        reach += step
    return best[:n]


def window_blocks(hashes: np.ndarray, window: int, anchor: int):
    """(first, last, anchor hash, block hash) of the blocks of one word
    sequence; first and last are window starts."""
    empty = np.empty(0, dtype=np.int64)
    if len(hashes) < window:
        return empty, empty, empty.astype(U64), empty.astype(U64)
    runs = rolling(hashes, anchor)
    at = argmin_windows(runs, window - anchor + 1)
    edge = np.flatnonzero(at[1:] != at[:-1]) + 1
    first = np.concatenate(([0], edge))
    last = np.concatenate((edge, [len(at)])) - 1
    anchors, content = runs[at[first]], spans_hash(hashes, first, last + window)
    # a word or phrase said over and over makes equal blocks in a row: one block
    new = np.concatenate(([True], (anchors[1:] != anchors[:-1]) | (content[1:] != content[:-1])))
    head = np.flatnonzero(new)
    tail = np.concatenate((head[1:], [len(new)])) - 1
    return first[head], last[tail], anchors[head], content[head]


def spans_hash(hashes: np.ndarray, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
    """Hash of the words start:end of a sequence, by prefix sums."""
    up, down = powers(len(hashes))
    acc = np.zeros(len(hashes) + 1, dtype=U64)
    words = mix(hashes ^ U64(salt)) if salt else hashes
    np.cumsum(words * up[:len(hashes)], out=acc[1:])
    return mix((acc[end] - acc[start]) * down[start] + (end - start).astype(U64))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_key, text); rows that share an id are told apart by their text."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"),
                       F.col(text_col).alias("text"))


def blocks(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """The blocks of every document with an id."""

    def cut(batches):
        for batch in batches:
            texts = batch["text"].to_pylist()
            ids, keys = batch["doc_id"].to_numpy(), batch["text_key"].to_numpy()
            for lo, hi in groups(texts):
                w = words_of(texts[lo:hi])
                parts, owner = [], []
                for i in range(hi - lo):
                    got = window_blocks(w.hash[w.first[i]:w.first[i + 1]], window, anchor)
                    if len(got[0]):
                        parts.append(got)
                        owner.append(np.full(len(got[0]), lo + i))
                if parts:
                    own = np.concatenate(owner)
                    first, last, a, b = (np.concatenate(x) for x in zip(*parts, strict=True))
                    yield pa.record_batch([pa.array(ids[own]), pa.array(keys[own]), pa.array(first), pa.array(last),
                                           _signed(a), _signed(b)],
                                          names=["doc_id", "text_key", "first", "last", "anchor", "block"])

    return prepared(docs.where("doc_id is not null and text is not null")).mapInArrow(cut, BLOCK)


def _runs(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, firsts, lasts) of an Arrow column of lists of (first, last); null: no runs."""
    column = column.fill_null([]) if column.null_count else column
    flat = column.flatten()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    return np.concatenate(([0], np.cumsum(sizes))), flat.field(0).to_numpy(), flat.field(1).to_numpy()


def probes(docs: DataFrame, wanted: DataFrame, window: int = WINDOW) -> DataFrame:
    """Hashes of all windows of the wanted blocks (doc_id, text_key, first, last)."""
    lists = wanted.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    rows = docs.join(lists, ["doc_id", "text_key"]).select("doc_id", "text_key", "text", "runs")

    def hashed(batches):
        for batch in batches:
            ids, keys = batch["doc_id"].to_numpy(), batch["text_key"].to_numpy()
            texts = batch["text"].to_pylist()
            offset, first, last = _runs(batch["runs"])
            for lo, hi in groups(texts):
                w = words_of(texts[lo:hi])
                parts = []
                for i in range(lo, hi):
                    h = w.hash[w.first[i - lo]:w.first[i - lo + 1]]
                    at = np.unique(np.concatenate([np.arange(a, b + 1) for a, b in zip(
                        first[offset[i]:offset[i + 1]].tolist(), last[offset[i]:offset[i + 1]].tolist(), strict=True)]))
                    parts.append((np.full(len(at), i), at, spans_hash(h, at, at + window),
                                  spans_hash(h, at, at + window, salt=SECOND)))
                own, at, key, key2 = (np.concatenate(x) for x in zip(*parts, strict=True))
                yield pa.record_batch([pa.array(ids[own]), pa.array(keys[own]), pa.array(at), _signed(key), _signed(key2)],
                                      names=["doc_id", "text_key", "at", "key", "key2"])

    return prepared(rows).mapInArrow(hashed, PROBE)


def factors(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, text_key, first, last): window starts, first to last, that are
    copied from documents with smaller ids. ``docs`` as ``_numbered`` gives it."""
    cut = stage(blocks(docs, window, anchor), "lz-blocks")
    # anchors that several documents share; ``several``: under differing blocks
    shared = cut.groupBy("anchor").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
        (F.min("block") != F.max("block")).alias("several")).where("low < high").select("anchor", "several")
    mine = stage(cut.join(shared, "anchor"), "lz-shared")
    reference = mine.groupBy("anchor", "block").agg(F.min("doc_id").alias("ref_doc"))
    found = stage(mine.join(reference, ["anchor", "block"])
                  .where("doc_id > ref_doc or several and doc_id = ref_doc")
                  .select("doc_id", "text_key", "first", "last", (F.col("doc_id") > F.col("ref_doc")).alias("whole")),
                  "lz-factors")
    copied = found.where("whole").drop("whole")
    # factor boundaries: first occurrences of blocks whose anchor has other blocks too
    probe = stage(probes(docs, found.where("not whole"), window), "lz-probes")
    earliest = probe.groupBy("key", "key2").agg(F.min("doc_id").alias("ref_doc"), F.max("doc_id").alias("high")) \
        .where("ref_doc < high").drop("high")
    partly = (probe.join(earliest, ["key", "key2"]).where("doc_id > ref_doc")
              .select("doc_id", "text_key", F.col("at").alias("first"), F.col("at").alias("last")))
    return copied.union(partly)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
          anchor: int = ANCHOR) -> DataFrame:
    """Remove copied windows; one row per row of ``docs`` with the removed
    word spans (first to last, inclusive) and the digest of what is kept."""
    rows = _numbered(docs, id_col, text_col)
    found = factors(rows, window, anchor).groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("first", "last")).alias("found"))
    joined = rows.join(found, ["doc_id", "text_key"], "left").select("doc_id", "text", "found")

    def clean(batches):
        for batch in batches:
            ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
            offset, first, last = _runs(batch["found"])
            out = []
            for i, text in enumerate(texts):
                w = words_of([text])
                n = len(w.hash)
                delta = np.zeros(n + 1, dtype=np.int64)
                np.add.at(delta, first[offset[i]:offset[i + 1]], 1)
                np.add.at(delta, last[offset[i]:offset[i + 1]] + window, -1)
                gone = np.cumsum(delta[:n]) > 0
                words = w.bytes_of(0, n)
                kept = b" ".join([words[k] for k in np.flatnonzero(~gone).tolist()] if gone.any() else words)
                edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
                out.append((ids[i], n, int(gone.sum()), hashlib.sha256(kept).hexdigest(),
                            [{"first": a, "last": b - 1} for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True)]))
            cols = list(zip(*out, strict=True)) or [()] * 5
            yield pa.record_batch([pa.array(c, type=t) for c, t in zip(cols, SCHEMA.types, strict=True)], schema=SCHEMA)

    return prepared(joined).mapInArrow(clean, OUT)


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                    ("kept_sha256", pa.string()),
                    ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))])
