"""Alignment of two tokenizers' tokens over a corpus.

Tokenizer A is a byte-level BPE (JSON file), B a SentencePiece model that puts
a blank before its text; A encodes blank + text. Both spell the same bytes, so
tokens of A and B are linked where their byte ranges overlap, and the offsets
where both end cut the text into groups.

1. ``tokenised``: one pass encodes every text with both tokenizers and aligns
   it. It writes the token ids of each document, and for each task the
   distinct (A id, B id) pairs with their counts there.
2. ``perfect_hash``: the distinct pairs are dealt out by hash; every part of
   about ``PART_PAIRS`` gets levels of bits in which a pair owns its bit where it is
   alone, the others go on to the next level. The rank of a pair's bit among
   all parts is its index: minimal, and a few bits a pair.
3. ``dense_counts``: a task adds its counts into a dense vector by index; the
   vectors are cut into slices and summed as a tree (lanes of tasks first,
   then slices). The key of each index is summed the same way (one task has
   it, the others zero), so that every look-up can verify its key.
4. ``aligned``: the second pass aligns each document's ids again and looks the
   counts of its links up in the vector.

Beyond ``INDEX_PAIRS`` distinct pairs index and vector are not sent to the tasks:
the documents' pairs are joined with the grouped counts. Same rows, tested.

Defined results
* null or empty text, or a text whose joined bytes under A or B differ from
  blank + text (B maps the word mark U+2581 to a blank): no tokens, zeros,
  groups_sha256 ''.
* special tokens' strings inside a text are plain text.
* null ids and repeated rows: every row gets its row. Ties: all links that
  share the highest count of a B id count as best.
* very long texts: encoded whole; ids and alignment of one text fit one task.
* extra columns: not read. Empty table: no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import U64, mix, prepared, stage, text_groups

TOKENIZERS = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Distinct pairs up to which index, keys and counts (24 bytes a pair) are sent to tasks.
INDEX_PAIRS = 4_000_000
PART_PAIRS = 1 << 14
#: Bytes of text encoded and aligned at a time.
TEXT_BYTES = 1 << 19
#: Distinct pairs a task holds before it writes them.
HELD_PAIRS = 1 << 20
#: Entries of a slice of a dense vector; lanes of the first round of the sum.
SLICE = 1 << 16
LANES = 16
# fixed value: the split pattern of the byte-level BPE
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


# -------------------------------------------------------------- tokenizers

def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: itself
    where it is printable, else the next letter from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


@dataclass(frozen=True)
class TokenizerFiles:
    """Contents of the two files; read by the driver and sent to the tasks."""

    a: bytes
    b: bytes

    @classmethod
    def load(cls, folder: str = TOKENIZERS, a: str = A_FILE, b: str = B_FILE) -> TokenizerFiles:
        with open(os.path.join(folder, a), "rb") as fa, open(os.path.join(folder, b), "rb") as fb:
            return cls(fa.read(), fb.read())


class Encoders:
    """Both tokenizers in a worker, and the bytes of their tokens."""

    def __init__(self, files: TokenizerFiles):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = json.loads(files.a)
        letters = byte_letters()
        special = {t["id"] for t in model.get("added_tokens", []) if t.get("special")}
        vocab = {i: bytes(letters[c] for c in t) for t, i in model["model"]["vocab"].items() if i not in special}
        self.a_bytes = [vocab.get(i, b"") for i in range(max([*vocab, *special]) + 1)]
        self._encode_a = self._byte_bpe(model, vocab) or self._library(files.a)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.b)
        proto = pb.ModelProto()
        proto.ParseFromString(files.b)
        byte = pb.ModelProto.SentencePiece.BYTE
        self.b_bytes = [bytes([int(p.piece[3:5], 16)]) if p.type == byte else p.piece.replace("▁", " ").encode() for p in proto.pieces]
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << 16:
            raise ValueError("token ids are packed in 16 bits")
        self.a_size, self.b_size = token_sizes(self)

    @staticmethod
    def _byte_bpe(model: dict, vocab: dict[int, bytes]):
        """The faster library, where ranks and ids of the vocabulary agree."""
        letters = byte_letters()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["model"]["merges"]]
        if any(vocab.get(256 + i) != bytes(letters[c] for c in a + b) for i, (a, b) in enumerate(merges)):
            return None
        import tiktoken

        own = tiktoken.Encoding("byte-bpe", pat_str=SPLIT, mergeable_ranks={t: i for i, t in vocab.items()}, special_tokens={})
        return lambda texts: [own.encode_ordinary(t) for t in texts]

    @staticmethod
    def _library(content: bytes):
        from tokenizers import Tokenizer

        own = Tokenizer.from_str(content.decode())
        own.encode_special_tokens = True
        return lambda texts: [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]

    def encode(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """(A ids, B ids) of each text; empty where the bytes do not agree."""
        given = [t for t in texts if t]
        pairs = zip(given, self._encode_a([" " + t for t in given]), self.b.encode(given, num_threads=1), strict=True)
        out = []
        for t in texts:
            if not t:
                out.append(([], []))
                continue
            _, a, b = next(pairs)
            want = b" " + t.encode("utf-8", "surrogatepass")
            same = b"".join(map(self.a_bytes.__getitem__, a)) == want == b"".join(map(self.b_bytes.__getitem__, b))
            out.append((a, b) if same else ([], []))
        return out


_LOADED: dict[int, Encoders] = {}


def token_sizes(e: Encoders) -> tuple[np.ndarray, np.ndarray]:
    return (np.array([len(x) for x in e.a_bytes], np.int64), np.array([len(x) for x in e.b_bytes], np.int64))


# --------------------------------------------------------------- alignment

@dataclass
class Alignment:
    """Links and groups of a run of documents laid end to end.

    ``code``: A id << 16 | B id of every link, in order; ``links`` and
    ``groups`` of document i are ``link_at[i]:link_at[i + 1]`` and so on.
    """

    code: np.ndarray
    link_at: np.ndarray
    group_at: np.ndarray
    ends: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray


def align(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, a_size: np.ndarray, b_size: np.ndarray) -> Alignment:
    """``a``, ``b``: ids of all documents, ``n_a``: A tokens of each. Bytes between
    two neighbouring ends lie in one A and one B token: one link."""
    end_a, end_b = np.cumsum(a_size[a]), np.cumsum(b_size[b])
    total = int(end_a[-1]) if len(end_a) else 0
    mark = np.zeros(total + 1, dtype=np.uint8)
    mark[end_a] = 1
    mark[end_b] |= 2
    ends = np.flatnonzero(mark)
    kind = mark[ends]
    in_a, in_b, both = (kind & 1).astype(bool), (kind & 2).astype(bool), kind == 3
    at_a, at_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    code = (a[at_a].astype(np.int64) << 16) | b[at_b].astype(np.int64)
    edge = np.concatenate(([0], end_a))[np.concatenate(([0], np.cumsum(n_a)))]  # byte where each document ends
    link_at = np.searchsorted(ends, edge, "right")
    link_at[0] = 0
    group_at = np.concatenate(([0], np.cumsum(both)))[link_at]
    return Alignment(code, link_at, group_at, both, in_a, in_b)


def group_order(al: Alignment, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Token ids of all documents in the order of the groups' text, A before B
    in each group, plus 2^16 x (0: a comma follows, 1: a bar, 2: a semicolon)."""
    groups = np.cumsum(al.ends) - al.ends
    ga, gb = groups[al.ends_a], groups[al.ends_b]
    n = int(groups[-1]) + 1 if len(groups) else 0
    b_until = np.concatenate(([0], np.cumsum(np.bincount(gb, minlength=n))))
    a_until = np.cumsum(np.bincount(ga, minlength=n))
    out = np.empty(len(a) + len(b), dtype=np.int64)
    out[np.arange(len(a)) + b_until[ga]] = a + (al.ends[al.ends_a].astype(np.int64) << 16)
    out[np.arange(len(b)) + a_until[gb]] = b + (al.ends[al.ends_b].astype(np.int64) << 17)
    return out


def spelled_ids() -> np.ndarray:
    """Decimal ids with what follows them, by the numbers of ``group_order``."""
    return np.array([b"%d%s" % (i, mark) for mark in (b",", b"|", b";") for i in range(1 << 16)], dtype=object)


# -------------------------------------------------------------- first pass

PASS_ONE = "row long, doc_id long, a binary, b binary, codes binary, counts binary"


def _merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not codes:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    got, at = np.unique(np.concatenate(codes), return_inverse=True)
    sums = np.zeros(len(got), np.int64)
    np.add.at(sums, at, np.concatenate(counts))
    return got, sums


def tokenised(docs: DataFrame, files: TokenizerFiles) -> DataFrame:
    """Rows with (row, doc_id, a, b): packed ids of a document; rows with (codes,
    counts): packed distinct pairs of a part of the corpus and their counts there."""
    sent = docs.sparkSession.sparkContext.broadcast(files)

    def encode(batches):
        from quarry.llm import token_alignment as own

        files = sent.value
        key = hash((files.a, files.b))
        if key not in own._LOADED:
            own._LOADED[key] = own.Encoders(files)
        enc = own._LOADED[key]
        codes, counts, held = [], [], 0
        for batch in batches:
            rows, ids = batch["row"], batch["doc_id"]
            for lo, texts in text_groups(batch["text"], TEXT_BYTES):
                got = enc.encode(texts)
                a = [np.array(x, np.uint16) for x, _ in got]
                b = [np.array(x, np.uint16) for _, x in got]
                al = align(np.concatenate(a), np.concatenate(b), np.array([len(x) for x in a]), enc.a_size, enc.b_size)
                c, n = np.unique(al.code, return_counts=True)
                codes.append(c)
                counts.append(n)
                held += len(c)
                if held >= 2 * HELD_PAIRS:
                    c, n = _merged(codes, counts)
                    codes, counts, held = [c], [n], len(c)
                    if held >= HELD_PAIRS:
                        yield _pairs_row(c, n)
                        codes, counts, held = [], [], 0
                none = pa.nulls(len(texts), pa.binary())
                yield pa.record_batch([rows.slice(lo, len(texts)), ids.slice(lo, len(texts)), pa.array([x.tobytes() for x in a], pa.binary()),
                                       pa.array([x.tobytes() for x in b], pa.binary()), none, none],
                                      names=["row", "doc_id", "a", "b", "codes", "counts"])
        c, n = _merged(codes, counts)
        if len(c):
            yield _pairs_row(c, n)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return prepared(rows).mapInArrow(encode, PASS_ONE)


def _pairs_row(codes, counts):
    none, blank = pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary())
    return pa.record_batch([none, none, blank, blank, pa.array([codes.astype(np.int64).tobytes()], pa.binary()),
                            pa.array([counts.astype(np.int64).tobytes()], pa.binary())], names=["row", "doc_id", "a", "b", "codes", "counts"])


def counted_pairs(first: DataFrame) -> DataFrame:
    """(code, n): the parts' pairs, one row each."""

    def explode(batches):
        for batch in batches:
            for c, n in zip(batch["codes"], batch["counts"], strict=True):
                yield pa.record_batch([pa.array(np.frombuffer(c.as_buffer(), np.int64)), pa.array(np.frombuffer(n.as_buffer(), np.int64))], names=["code", "n"])

    return first.where("codes is not null").select("codes", "counts").mapInArrow(explode, "code long, n long")


# ----------------------------------------------------- minimal perfect hash

def _place(codes: np.ndarray, level: int, size) -> np.ndarray:
    return (mix(codes.astype(U64) + U64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % np.asarray(size, dtype=U64)).astype(np.int64)


def _part(codes: np.ndarray, parts: int) -> np.ndarray:
    return (mix(codes.astype(U64) ^ U64(0xA0761D6478BD642F)) % U64(parts)).astype(np.int64)


def levels_of(codes: np.ndarray) -> list[np.ndarray]:
    """Bits of one part: a code owns its place on the first level where it is alone."""
    out = []
    while len(codes):
        size = 2 * len(codes)
        at = _place(codes, len(out), size)
        alone = np.bincount(at, minlength=size) == 1
        out.append(alone)
        codes = codes[~alone[at]]
    return out


class PerfectHash:
    """Index in 0..n-1 of each of n codes."""

    def __init__(self, parts: list[list[np.ndarray]]):
        deepest = max((len(p) for p in parts), default=0)
        self.size = np.zeros((len(parts), max(deepest, 1)), dtype=np.int64)
        for i, p in enumerate(parts):
            self.size[i, :len(p)] = [len(x) for x in p]
        self.base = np.concatenate(([0], np.cumsum(self.size.ravel())))[:-1].reshape(self.size.shape)
        flat = np.concatenate([np.zeros(0, bool), *[x for p in parts for x in p]])
        self.n = int(flat.sum())
        packed = np.packbits(np.concatenate((flat, np.zeros(-len(flat) % 64 + 64, bool))), bitorder="little").view(U64)
        self.bits = packed
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)))[:-1]

    def index(self, codes: np.ndarray) -> np.ndarray:
        """-1, or any index, for a code that is not one of the n: compare keys."""
        out = np.full(len(codes), -1, dtype=np.int64)
        if not len(self.size):
            return out
        part, todo = _part(codes, len(self.size)), np.arange(len(codes))
        for level in range(self.size.shape[1]):
            size = self.size[part[todo], level]
            todo = todo[size > 0]
            p = self.base[part[todo], level] + _place(codes[todo], level, size[size > 0])
            word, bit = self.bits[p >> 6], (p & 63).astype(U64)
            hit = (word >> bit) & U64(1) == 1
            below = np.bitwise_count(word & ((U64(1) << bit) - U64(1)))
            out[todo[hit]] = (self.before[p >> 6] + below)[hit]
            todo = todo[~hit]
        return out


def perfect_hash(distinct: DataFrame, n: int, part_pairs: int = PART_PAIRS) -> PerfectHash:
    """``distinct``: (code). The bits of a part are found in a task; the driver
    puts them side by side (about four bits a code)."""
    parts = max(1, -(-n // part_pairs))

    def number(batches):
        for batch in batches:
            codes = batch["code"].to_numpy()
            yield pa.record_batch([batch["code"], pa.array(_part(codes, parts))], names=["code", "part"])

    def place(batches):
        for batch in batches:
            for part, codes in zip(batch["part"].to_pylist(), batch["codes"], strict=True):
                found = levels_of(codes.values.to_numpy())
                bits = np.packbits(np.concatenate([np.zeros(0, bool), *found]), bitorder="little").tobytes()
                yield pa.record_batch([pa.array([part]), pa.array([[len(x) for x in found]], pa.list_(pa.int64())), pa.array([bits], pa.binary())],
                                      names=["part", "sizes", "bits"])

    dealt = prepared(distinct).select("code").mapInArrow(number, "code long, part long").groupBy("part").agg(F.collect_list("code").alias("codes"))
    got = dealt.select("part", "codes").mapInArrow(place, "part long, sizes array<long>, bits binary").toArrow()
    out: list[list[np.ndarray]] = [[] for _ in range(parts)]
    for part, sizes, bits in zip(*(got.column(c).to_pylist() for c in ("part", "sizes", "bits")), strict=True):
        flat = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").astype(bool)
        edge = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        out[part] = [flat[edge[i]:edge[i + 1]] for i in range(len(sizes))]
    return PerfectHash(out)


def dense_sum(rows: DataFrame, index, value: str, slice_: int = SLICE, lanes: int = LANES) -> np.ndarray:
    """Sum of ``value`` over ``rows`` (code, value) by the index of the code: one
    dense vector a task, cut in slices, summed by lane and then over the lanes."""

    def vector(batches):
        from pyspark import TaskContext

        ph = index.value
        vec = np.zeros(ph.n, np.int64)
        for batch in batches:
            np.add.at(vec, ph.index(batch["code"].to_numpy()), batch[value].to_numpy())
        lane = TaskContext.get().partitionId() % lanes
        for k in range(0, ph.n, slice_):
            part = vec[k:k + slice_]
            if part.any():
                yield pa.record_batch([pa.array([k // slice_]), pa.array([lane]), pa.array([part.tobytes()], pa.binary())], names=["slice", "lane", "v"])

    def add(batches):
        place, total = None, None
        for batch in batches:
            for s, lane, v in zip(batch["slice"].to_pylist(), batch["lane"].to_pylist(), batch["v"], strict=True):
                part = np.frombuffer(v.as_buffer(), np.int64)
                if (s, lane) != place:
                    if place is not None:
                        yield _slice_row(place, total)
                    place, total = (s, lane), part.copy()
                else:
                    total += part
        if place is not None:
            yield _slice_row(place, total)

    schema = "slice long, lane long, v binary"
    parts = prepared(rows).select("code", value).mapInArrow(vector, schema)
    parts = parts.repartition("slice", "lane").sortWithinPartitions("slice", "lane").mapInArrow(add, schema)
    parts = parts.withColumn("lane", F.lit(0).cast("long")).repartition("slice").sortWithinPartitions("slice").mapInArrow(add, schema)
    n = index.value.n
    out = np.zeros(n, np.int64)
    got = parts.select("slice", "v").toArrow()
    for s, v in zip(got.column("slice").to_pylist(), got.column("v").to_pylist(), strict=True):
        out[s * slice_:(s + 1) * slice_] = np.frombuffer(v, np.int64)
    return out


def _slice_row(place, total):
    return pa.record_batch([pa.array([place[0]]), pa.array([place[1]]), pa.array([total.tobytes()], pa.binary())], names=["slice", "lane", "v"])


@dataclass
class PairCounts:
    """Counts of all pairs by perfect hash, and the highest count of each B id."""

    index: PerfectHash
    keys: np.ndarray
    counts: np.ndarray
    best: np.ndarray

    def look_up(self, codes: np.ndarray) -> np.ndarray:
        """Counts of ``codes``; 0 for a pair that the corpus does not hold."""
        if not len(self.keys):
            return np.zeros(len(codes), np.int64)
        at = self.index.index(codes)
        return np.where((at >= 0) & (self.keys[np.maximum(at, 0)] == codes), self.counts[np.maximum(at, 0)], 0)


def pair_counts(pairs: DataFrame, distinct: DataFrame, n: int) -> PairCounts:
    index = perfect_hash(distinct, n)
    if index.n != n:
        raise RuntimeError("the index does not hold every pair")
    sent = distinct.sparkSession.sparkContext.broadcast(index)
    keys = dense_sum(distinct.withColumn("key", F.col("code")), sent, "key")
    counts = dense_sum(pairs, sent, "n")
    best = np.zeros(1 << 16, np.int64)
    np.maximum.at(best, keys & 0xFFFF, counts)
    return PairCounts(index, keys, counts, best)


# ------------------------------------------------------------- second pass

ROWS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, codes binary"


def aligned(first: DataFrame, files: TokenizerFiles, counts: PairCounts | None) -> DataFrame:
    """One row a document; without ``counts`` the links' codes instead of their sums."""
    context = first.sparkSession.sparkContext
    e = Encoders(files)
    sent = context.broadcast((e.a_size, e.b_size, counts))

    def rows(batches):
        a_size, b_size, counts = sent.value
        spelled = spelled_ids()
        for batch in batches:
            size = np.cumsum([len(x.as_buffer()) for x in batch["a"]])
            lo = 0
            while lo < batch.num_rows:
                done = size[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(size, done + TEXT_BYTES, "right")))
                part = batch.slice(lo, hi - lo)
                yield _aligned_rows(part, a_size, b_size, counts, spelled)
                lo = hi

    docs = first.where("a is not null").select("row", "doc_id", "a", "b")
    return prepared(docs).mapInArrow(rows, ROWS)


def _aligned_rows(batch, a_size, b_size, counts, spelled):
    a_of = [np.frombuffer(x.as_buffer(), np.uint16) for x in batch["a"]]
    b_of = [np.frombuffer(x.as_buffer(), np.uint16) for x in batch["b"]]
    n_a, n_b = np.array([len(x) for x in a_of], np.int64), np.array([len(x) for x in b_of], np.int64)
    a, b = np.concatenate(a_of).astype(np.int64), np.concatenate(b_of).astype(np.int64)
    al = align(a, b, n_a, a_size, b_size)
    order = group_order(al, a, b)
    token_at = np.concatenate(([0], np.cumsum(n_a + n_b)))
    sha = [hashlib.sha256(b"".join(spelled[order[x:y]])[:-1]).hexdigest() if y > x else "" for x, y in zip(token_at[:-1].tolist(), token_at[1:].tolist(), strict=True)]
    none = np.zeros(len(n_a), np.int64)
    n_best, total, codes = none, none, pa.nulls(len(n_a), pa.binary())
    if counts is None:
        codes = pa.array([al.code[x:y].tobytes() for x, y in zip(al.link_at[:-1].tolist(), al.link_at[1:].tolist(), strict=True)], pa.binary())
    else:
        got = counts.look_up(al.code)
        of = lambda x: np.diff(np.concatenate(([0], np.cumsum(x, dtype=np.int64)))[al.link_at])
        n_best, total = of(got == counts.best[al.code & 0xFFFF]), of(got)
    return pa.record_batch(
        [batch["row"], batch["doc_id"], pa.array(n_a), pa.array(n_b), pa.array(np.diff(al.group_at)), pa.array(np.diff(al.link_at)),
         pa.array(n_best), pa.array(total), pa.array(sha), codes],
        names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "codes"])


OUT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _by_join(first: DataFrame, files: TokenizerFiles, pairs: DataFrame) -> DataFrame:
    """The same rows where the pairs are too many to send: documents' pairs join the grouped counts."""
    counts = stage(pairs.groupBy("code").agg(F.sum("n").alias("count")), "align-counts")
    best = counts.groupBy(F.col("code").bitwiseAND(0xFFFF).alias("b")).agg(F.max("count").alias("most"))
    rows = stage(aligned(first, files, None), "align-rows")

    def explode(batches):
        for batch in batches:
            for row, codes in zip(batch["row"].to_pylist(), batch["codes"], strict=True):
                c, n = np.unique(np.frombuffer(codes.as_buffer(), np.int64), return_counts=True)
                yield pa.record_batch([pa.array(np.full(len(c), row)), pa.array(c), pa.array(n.astype(np.int64))], names=["row", "code", "n"])

    links = rows.select("row", "codes").mapInArrow(explode, "row long, code long, n long")
    # the counts with their B id's highest are one row a pair, so the documents' side is the only skewed one
    known = counts.join(best, F.col("code").bitwiseAND(0xFFFF) == F.col("b")).select("code", "count", "most")
    sums = links.join(known, "code").groupBy("row").agg(
        F.sum(F.when(F.col("count") == F.col("most"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum"))
    return (rows.drop("n_best", "count_sum", "codes").join(sums, "row", "left")
            .withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_best", "count_sum")}).select(*OUT))


def align_corpus(docs: DataFrame, files: TokenizerFiles | None = None, index_pairs: int = INDEX_PAIRS) -> DataFrame:
    """One row for every row of ``docs`` (doc_id, text)."""
    files = files or TokenizerFiles.load()
    first = stage(tokenised(docs, files), "align-tokens")
    pairs = counted_pairs(first)
    distinct = stage(pairs.select("code").distinct(), "align-pairs")
    n = distinct.count()
    if n > index_pairs:
        return _by_join(first, files, pairs)
    return aligned(first, files, pair_counts(pairs, distinct, n)).select(*OUT)
