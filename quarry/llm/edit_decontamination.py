"""Benchmark decontamination by pigeonhole edit matching.

A test item of m words leaks if some run of a document's words lies within
k = floor(rate * m) word edits of it. Cut the item into k + 1 pieces: k edits
leave one piece untouched, so every leak holds an exact piece hit. Documents
are scanned for the hashes of all pieces; around each hit the item is
verified with Myers' bit-parallel distance, one bit per word of the item.

The items go to the executors in blocks of at most ``BLOCK_BYTES`` of text,
one scan of the documents per block, so what is broadcast is bounded however
large the benchmark is; documents are scanned where they are read, without a
shuffle, and each document's hits stay in its task.

Words are maximal runs of 0-9, a-z and characters beyond ASCII of the text
with A-Z lower-cased, so case, punctuation and spacing do not hide a leak.

Defined results
* null or empty document text: no match. Null document id: matched, id null.
* null item text or an item without a word: never found. Items of any length
  of one word or more are searched; short ones (no edit allowed) word for word.
* repeated items: each id is reported. Repeated document rows: each matches.
* ties: of equal distances in a document the first place is reported.
* very long texts: hashed in bounded pieces; only hits are verified.
* extra columns: only id and text of either side are read (``clean`` keeps all).
* empty tables: no matches.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import ALNUM, U64, groups, prepared, rolling, words_of

EDIT_RATE = 0.15
MIN_WORDS = 1
BLOCK_BYTES = 8 << 20
TABLE_BITS = 20

OUT = "doc_id long, item_id long, distance long, item_words long, first_word long, last_word long"


def budget(n_words: int, rate: float = EDIT_RATE) -> int:
    return int(math.floor(rate * n_words + 1e-9))


def cuts(n_words: int, k: int) -> list[tuple[int, int]]:
    """k + 1 pieces (start, length) that tile n_words, lengths differing by one at most."""
    edge = [i * n_words // (k + 1) for i in range(k + 2)]
    return [(a, b - a) for a, b in zip(edge[:-1], edge[1:], strict=True)]


def myers(pattern: dict[bytes, int], m: int, text: list[bytes]) -> tuple[int, int]:
    """(distance, end) of the best occurrence of the pattern in ``text``: the
    least edit distance to any run of words, and the first place it ends.

    ``pattern`` maps a word to the bits of its places. Myers' recurrences on
    vertical deltas; Python integers hold the m bits.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, -1
    for j, w in enumerate(text):
        eq = pattern.get(w, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(horizontal | plus) & full
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        if score < best:
            best, end = score, j
        up, down = (up << 1) & full, (down << 1) & full
        plus = down | ~(vertical | up) & full
        minus = up & vertical
    return best, end


def start_of(pattern: list[bytes], text: list[bytes], end: int, distance: int) -> int:
    """Last start of a run that ends at ``end`` within ``distance`` of the pattern: Myers from the back."""
    back = text[end::-1]
    bits: dict[bytes, int] = {}
    for i, w in enumerate(reversed(pattern)):
        bits[w] = bits.get(w, 0) | 1 << i
    m = len(pattern)
    _, at = myers(bits, m, back[:m + distance])
    return end - max(at, 0)


@dataclass
class Item:
    item_id: int
    words: list[bytes]
    edits: int
    bits: dict[bytes, int]


class PieceIndex:
    """Hashes of all pieces of a block of items."""

    def __init__(self, items: list[tuple[int, str]], rate: float = EDIT_RATE, min_words: int = MIN_WORDS):
        self.items: list[Item] = []
        found: dict[int, list[tuple[int, int, int]]] = {}
        for item_id, text in items:
            w = words_of([text], ALNUM, lower=True)
            m = len(w.hash)
            if m < max(min_words, 1):
                continue
            k = budget(m, rate)
            ws = w.bytes_of(0, m)
            bits: dict[bytes, int] = {}
            for i, x in enumerate(ws):
                bits[x] = bits.get(x, 0) | 1 << i
            for start, length in cuts(m, k):
                h = int(rolling(w.hash[start:start + length], length)[0])
                found.setdefault(length, []).append((h, len(self.items), start))
            self.items.append(Item(item_id, ws, k, bits))
        self.by_length = {}
        for length, rows in found.items():
            rows.sort()
            table = np.zeros(1 << TABLE_BITS, dtype=bool)
            h = np.array([r[0] for r in rows], dtype=U64)
            table[(h >> U64(64 - TABLE_BITS)).astype(np.int64)] = True
            self.by_length[length] = (table, h, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))

    def hits(self, hashes: np.ndarray):
        """(word place, item, start in the item) of all exact piece hits."""
        for length, (table, keys, item, start) in self.by_length.items():
            h = rolling(hashes, length)
            maybe = np.flatnonzero(table[(h >> U64(64 - TABLE_BITS)).astype(np.int64)])
            lo = np.searchsorted(keys, h[maybe], "left")
            hi = np.searchsorted(keys, h[maybe], "right")
            for p, a, b in zip(maybe[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True):
                for r in range(a, b):
                    yield p, int(item[r]), int(start[r])

    def matches(self, words, first: int, last: int):
        """Verified (item, distance, first word, last word) in the words first:last, one per item: the best."""
        windows: dict[int, list[tuple[int, int]]] = {}
        n = last - first
        for p, i, s in self.hits(words.hash[first:last]):
            it = self.items[i]
            a = max(0, p - s - it.edits)
            windows.setdefault(i, []).append((a, min(n, p - s + len(it.words) + it.edits)))
        for i, spans in sorted(windows.items()):
            it, best = self.items[i], None
            for a, b in merged(spans):
                text = words.bytes_of(first + a, first + b)
                d, end = myers(it.bits, len(it.words), text)
                if d <= it.edits and (best is None or d < best[1]):
                    best = (i, d, a + start_of(it.words, text, end, d), a + end)
            if best:
                yield best


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of overlapping windows."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES):
    """Blocks of at most about ``block_bytes`` of item text, streamed partition by partition."""
    block, size = [], 0
    rows = benchmark.select(F.col(id_col).cast("long"), text_col).where(F.col(text_col).isNotNull())
    for item_id, text in rows.toLocalIterator():
        if block and size + len(text) > block_bytes:
            yield block
            block, size = [], 0
        block.append((item_id, text))
        size += len(text)
    if block:
        yield block


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE, min_words: int = MIN_WORDS,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, distance, item_words, first_word, last_word): the best
    place of every benchmark item that a document holds within the budget."""
    rows = prepared(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    found = None
    for block in item_blocks(benchmark, block_bytes=block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def search(batches, sent=sent):
            index = PieceIndex(sent.value, rate, min_words)
            for batch in batches:
                ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
                out = []
                for lo, hi in groups(texts):
                    w = words_of(texts[lo:hi], ALNUM, lower=True)
                    for i in range(lo, hi):
                        for item, d, a, b in index.matches(w, int(w.first[i - lo]), int(w.first[i - lo + 1])):
                            it = index.items[item]
                            out.append((ids[i], it.item_id, d, len(it.words), a, b))
                cols = list(zip(*out, strict=True)) or [()] * 6
                yield pa.record_batch([pa.array(c, pa.int64()) for c in cols],
                                      names=["doc_id", "item_id", "distance", "item_words", "first_word", "last_word"])

        part = rows.mapInArrow(search, OUT)
        found = part if found is None else found.union(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], OUT)


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; rows without an id are kept."""
    dirty = leaks(docs, benchmark, **options).select("doc_id").distinct()
    return docs.join(dirty, "doc_id", "left_anti")
