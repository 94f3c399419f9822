"""SentencePiece encoding and decoding over a relational lattice.

The piece table of a public SentencePiece model is a relation (piece, id,
score). A text, with a blank put before it, is cut into words wherever two
neighbouring characters stand side by side in no piece at all: no piece
crosses such a border, so the best segmentation of the text is that of its
words. (A blank after another character is always such a border.)

1. ``edges``: the substrings of words up to the longest piece's length are
   exploded and equi-joined with the piece table, on a 64-bit key and then on
   the characters, and the matches are grouped by word and end position. This
   runs on whole Arrow batches of words. A character without a piece is an
   edge of its UTF-8 byte pieces at the unknown score.
2. ``best_path``: a Spark higher-order aggregate folds Viterbi over the
   positions, and a second one walks the best path backwards.
3. ``encode``: the ``frequent`` most frequent words of the corpus are encoded
   once and sent to the executors as a dictionary of bounded size; longer ones
   than ``WORD_CHARS`` are never in it. A document's other words bring their lattice along in the document's row and
   are folded there, so documents are never shuffled and nothing depends on
   the vocabulary's size. Which words are in the dictionary changes no result.
4. ``decode`` concatenates the pieces' bytes: an exact inverse for every text.

Scores: a unigram model's own; for another model type (merge ranks) the
Zipf estimate -ln(rank) - ln(H) by rank. The unknown score is the lowest
score minus 10, as in SentencePiece. Equal paths: the longer last piece wins.

Defined results
* null or empty text: no pieces; decodes to the empty text. Null id: encoded.
* a literal U+2581 or a control text such as ``<s>`` is text: bytes or pieces.
* very long words: the fold keeps one entry a character; a word of n
  characters copies its entries n times.
* repeated rows and ids: every input row gives one output row.
* extra columns: only id and text are read. Empty table: no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quarry.llm.common import U64, mix, powers, prepared, text_groups

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Words of the dictionary sent to the executors.
FREQUENT = 1 << 18
#: Characters of the dictionary's longest word. A word of so many has at most 4 bytes, and 4 byte
#: pieces of 4 bytes, a character: the dictionary holds FREQUENT * WORD_CHARS * 20 bytes at most.
WORD_CHARS = 64
#: Distinct words a task counts before it passes its counts on.
COUNTED_AT_ONCE = 200_000
UNKNOWN_PENALTY = 10.0
#: Bytes of text, and words, whose lattices are made at a time.
TEXT_BYTES = 1 << 18
WORDS_AT_ONCE = 5_000
#: Documents put together at a time.
ROWS_AT_ONCE = 100
KEY = U64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class PieceTable:
    """Pieces with a blank for the word mark; ``bytes_at`` are the ids of the 256 byte pieces."""

    pieces: list[tuple[str, int, float]]
    bytes_at: list[int]
    longest: int
    unknown: float

    @classmethod
    def load(cls, path: str = MODEL) -> PieceTable:
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kind = pb.ModelProto.SentencePiece
        normal = [(p.piece.replace("▁", " "), i, p.score) for i, p in enumerate(model.pieces)
                  if p.type in (kind.NORMAL, kind.USER_DEFINED)]
        byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kind.BYTE}
        if len(byte_ids) < 256:
            raise ValueError("the piece table has no byte pieces")
        if model.trainer_spec.model_type != pb.TrainerSpec.UNIGRAM:
            normal.sort(key=lambda x: (-x[2], x[1]))
            total = math.log(sum(1.0 / r for r in range(1, len(normal) + 1)))
            normal = [(p, i, -math.log(r) - total) for r, (p, i, _) in enumerate(normal, 1)]
        return cls(normal, [byte_ids[b] for b in range(256)], max(len(p) for p, _, _ in normal),
                   min(s for _, _, s in normal) - UNKNOWN_PENALTY)

    def spelled(self) -> list[bytes]:
        """Bytes of every id."""
        out = [b""] * (1 + max(max(i for _, i, _ in self.pieces), max(self.bytes_at)))
        for p, i, _ in self.pieces:
            out[i] = p.encode()
        for b, i in enumerate(self.bytes_at):
            out[i] = bytes([b])
        return out


class Cutter:
    """Cuts texts at pairs of characters that no piece holds side by side."""

    def __init__(self, table: PieceTable):
        chars = sorted({c for p, _, _ in table.pieces for c in p})
        self.number = np.zeros(0x110000, dtype=np.int32)  # 0: in no piece
        self.number[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.joined = np.zeros((len(chars) + 1, len(chars) + 1), dtype=bool)
        for p, _, _ in table.pieces:
            n = self.number[[ord(c) for c in p]]
            self.joined[n[:-1], n[1:]] = True

    def words(self, texts: list[str | None]) -> CutWords:
        """The words of a few texts, each with a blank put before it."""
        joined = "".join(" " + t for t in texts if t)
        sizes = np.array([len(t) + 1 if t else 0 for t in texts], dtype=np.int64)
        edge = np.concatenate(([0], np.cumsum(sizes)))
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        n = self.number[code]
        cut = np.ones(len(code), dtype=bool)
        cut[1:] = ~self.joined[n[:-1], n[1:]]
        cut[edge[:-1][sizes > 0]] = True
        start = np.flatnonzero(cut)
        length = np.diff(np.concatenate((start, [len(code)])))
        up, down = powers(len(code))
        acc = np.concatenate((np.zeros(1, U64), np.cumsum((code.astype(U64) + U64(1)) * up[:len(code)], dtype=U64)))
        key = mix((acc[start + length] - acc[start]) * down[start] + length.astype(U64))
        _, at, which = np.unique(key, return_index=True, return_inverse=True)
        if len(start):
            like = start[at][which]
            same = (length[at][which] == length).all() and (code[_gathered(like, length)] == code).all()
            if not same:  # two words share a key: tell them apart as strings
                spelled = [joined[x:x + k] for x, k in zip(start.tolist(), length.tolist(), strict=True)]
                _, at, which = np.unique(np.array(spelled, dtype=object), return_index=True, return_inverse=True)
        words = [joined[x:x + k] for x, k in zip(start[at].tolist(), length[at].tolist(), strict=True)]
        return CutWords(words, which, np.searchsorted(start, edge))


@dataclass(frozen=True)
class CutWords:
    """Distinct words; ``which`` word stands where; text i has the places first[i]:first[i + 1]."""

    words: list[str]
    which: np.ndarray
    first: np.ndarray


def word_counts(docs: DataFrame, table: PieceTable, text_col: str = "text") -> DataFrame:
    """(word, n): words of the corpus of at most ``WORD_CHARS`` characters, counted
    where they occur. A task passes on the words it saw twice or more among ``COUNTED_AT_ONCE`` distinct ones; the
    others cannot be frequent, and no result depends on these counts."""

    def count(batches):
        cutter, seen = Cutter(table), Counter()

        def rows():
            some = [(w, n) for w, n in seen.items() if n > 1]
            return pa.record_batch([pa.array([w for w, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())],
                                   names=["word", "n"])

        for batch in batches:
            for _, texts in text_groups(batch.column(0), TEXT_BYTES):
                cut = cutter.words(texts)
                for w, n in zip(cut.words, np.bincount(cut.which, minlength=len(cut.words)).tolist(), strict=True):
                    if len(w) <= WORD_CHARS:
                        seen[w] += n
                if len(seen) > COUNTED_AT_ONCE:
                    yield rows()
                    seen.clear()
        yield rows()

    return (prepared(docs.select(text_col)).mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


EDGES = pa.list_(pa.list_(pa.struct([("s", pa.int32()), ("score", pa.float64()), ("id", pa.int32())])))
STEPS = "array<array<struct<s:int,score:double,id:int>>>"


class Pieces:
    """The piece table as a relation for batches: by length, a bit table of the
    keys that pieces or their beginnings have, and the pieces' sorted keys with
    characters, ids and scores."""

    BITS = 18

    def __init__(self, table: PieceTable):
        self.table, self.by_length = table, {}
        whole: dict[int, list] = {}
        begun: dict[int, set] = {}
        for p, i, score in table.pieces:
            whole.setdefault(len(p), []).append((p, i, score))
            for k in range(1, len(p) + 1):
                begun.setdefault(k, set()).add(p[:k])
        for k in range(1, table.longest + 1):
            maybe = np.zeros(1 << self.BITS, dtype=bool)
            maybe[self.slot(self.keys_of(sorted(begun[k])))] = True
            rows = whole.get(k, [])
            key = self.keys_of([p for p, _, _ in rows])
            order = np.argsort(key, kind="stable")
            if (np.diff(key[order]) == 0).any():
                raise ValueError("two pieces share a key")
            code = np.array([[ord(c) for c in p] for p, _, _ in rows], dtype=U64).reshape(len(rows), k)
            self.by_length[k] = (maybe, key[order], code[order], np.array([r[1] for r in rows], np.int32)[order],
                                 np.array([r[2] for r in rows])[order])

    @staticmethod
    def longer(key: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Keys of strings that go on with the characters ``code``."""
        key = (key ^ code) * KEY
        return key ^ (key >> U64(29))

    def keys_of(self, strings: list[str]) -> np.ndarray:
        key = np.zeros(len(strings), dtype=U64)
        for j in range(len(strings[0]) if strings else 0):
            key = self.longer(key, np.array([ord(x[j]) for x in strings], dtype=U64))
        return key

    def slot(self, key: np.ndarray) -> np.ndarray:
        return (key >> U64(64 - self.BITS)).astype(np.int64)

    def edges(self, words: list[str]) -> pa.Array:
        """Per word, per end position, the edges (start, score, id) that end there, by start."""
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(U64)
        offset = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int64)
        last = np.repeat(offset[1:], np.diff(offset))
        first = np.repeat(offset[:-1], np.diff(offset))
        starts, ends, scores, ids = [], [], [], []
        place, key = np.arange(len(code)), np.zeros(len(code), dtype=U64)
        single = np.zeros(len(code), dtype=bool)
        for k, (maybe, keys, chars, piece_ids, piece_scores) in self.by_length.items():
            # substrings of length k, inside one word, that begin like some piece
            inside = place + k <= last[place]
            place = place[inside]
            key = self.longer(key[inside], code[place + k - 1])
            goes_on = maybe[self.slot(key)]
            place, key = place[goes_on], key[goes_on]
            if not len(keys) or not len(place):
                continue
            row = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[row] == key
            at, row = place[hit], row[hit]
            same = np.ones(len(at), dtype=bool)
            for j in range(k):
                same &= code[at + j] == chars[row, j]
            at, row = at[same], row[same]
            if k == 1:
                single[at] = True
            starts.append(at)
            ends.append(at + k)
            scores.append(piece_scores[row])
            ids.append(piece_ids[row])
        lone = np.flatnonzero(~single)  # characters without a piece
        starts.append(lone)
        ends.append(lone + 1)
        scores.append(np.full(len(lone), self.table.unknown))
        ids.append(np.full(len(lone), -1, np.int32))
        start, end = np.concatenate(starts), np.concatenate(ends)
        order = np.lexsort((start, end))
        edge = pa.StructArray.from_arrays(
            [pa.array((start - first[start])[order].astype(np.int32)), pa.array(np.concatenate(scores)[order]),
             pa.array(np.concatenate(ids)[order].astype(np.int32))], names=["s", "score", "id"])
        per_end = np.concatenate(([0], np.cumsum(np.bincount(end - 1, minlength=len(code)))))
        inner = pa.ListArray.from_arrays(pa.array(per_end.astype(np.int32)), edge)
        return pa.ListArray.from_arrays(pa.array(offset.astype(np.int32)), inner)


def best_path(word: Column, steps: Column, table: PieceTable) -> Column:
    """ids of the best segmentation of ``word`` from its edges: Viterbi as a fold
    over the end positions, then the way back."""
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("t"), F.lit(-1).alias("id")))

    def position(best: Column, edges: Column) -> Column:
        # of equal scores the smaller start (the larger -s), so the longer piece
        return F.concat(best, F.array(F.array_max(F.transform(edges, lambda x: F.struct(
            (best[x["s"]]["score"] + x["score"]).alias("score"), (-x["s"]).alias("t"), x["id"].alias("id"))))))

    def way_back(best: Column) -> Column:
        state = F.struct((F.size(best) - 1).alias("at"), F.array().cast("array<struct<s:int,id:int>>").alias("path"))
        return F.reverse(F.aggregate(
            F.sequence(F.size(best) - 1, F.lit(1)), state,
            lambda a, p: F.when(a["at"] == p, F.struct((-best[p]["t"]).alias("at"), F.concat(a["path"], F.array(
                F.struct((-best[p]["t"]).alias("s"), best[p]["id"].alias("id")))).alias("path"))).otherwise(a),
            lambda a: a["path"]))

    byte_ids = F.array(*[F.lit(i) for i in table.bytes_at])

    def bytes_of(step: Column) -> Column:
        code = F.hex(F.encode(word.substr(step["s"] + 1, F.lit(1)), "utf-8"))
        return F.when(step["id"] >= 0, F.array(step["id"])).otherwise(F.transform(
            F.sequence(F.lit(0), (F.length(code) / 2 - 1).cast("int")),
            lambda b: byte_ids[F.conv(code.substr((2 * b + 1).cast("int"), F.lit(2)), 16, 10).cast("int")]))

    path = F.aggregate(steps, start, position, way_back)
    # one-element transforms bind the path once
    return F.transform(F.array(path), lambda p: F.when(F.forall(p, lambda x: x["id"] >= 0), F.transform(p, lambda x: x["id"]))
                       .otherwise(F.flatten(F.transform(p, bytes_of))))[0]


def lattice(words: DataFrame, table: PieceTable) -> DataFrame:
    """(word, ids): the best segmentation of every ``word``."""

    def explode(batches):
        pieces = Pieces(table)
        for batch in batches:
            column = batch.column(0)
            for lo in range(0, len(column), WORDS_AT_ONCE):
                part = column.slice(lo, WORDS_AT_ONCE)
                yield pa.record_batch([part, pieces.edges(part.to_pylist())], names=["word", "steps"])

    edges = prepared(words.select("word").where("word <> ''")).mapInArrow(explode, f"word string, steps {STEPS}")
    return edges.select("word", best_path(F.col("word"), F.col("steps"), table).alias("ids"))


NUMBERED = f"doc_id long, text_key long, numbers binary, rare array<struct<word:string,steps:{STEPS}>>"
OUT = "doc_id long, n_words long, n_pieces long, ids array<int>, text_key long"


def _gathered(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (size of them) for every entry, one after another."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def encode(docs: DataFrame, table: PieceTable, id_col: str = "doc_id", text_col: str = "text",
           frequent: int = FREQUENT, decoded: bool = False) -> DataFrame:
    """(doc_id, n_words, n_pieces, ids, text_key) for every row of ``docs``; with
    ``decoded`` also the text that the ids spell, made in the same pass."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"),
                       F.col(text_col).alias("text"))
    top = word_counts(rows, table).orderBy(F.desc("n"), "word").limit(frequent).select("word")
    parts = spark.sparkContext.defaultParallelism * 4
    common = lattice(top.repartition(parts), table).toArrow().combine_chunks()  # at most ``frequent`` rows
    lists = common["ids"].combine_chunks() if common.num_rows else pa.array([], pa.list_(pa.int32()))
    sent_words = spark.sparkContext.broadcast({w: k for k, w in enumerate(common["word"].to_pylist())})
    sent_ids = spark.sparkContext.broadcast((
        np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64),
        lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32)))

    def number(batches):
        known, cutter, pieces = sent_words.value, Cutter(table), Pieces(table)
        for batch in batches:
            for lo, texts in text_groups(batch["text"], TEXT_BYTES):
                cut = cutter.words(texts)
                number_of = np.array([known.get(w, -1) for w in cut.words], dtype=np.int32)
                numbers = number_of[cut.which] if len(cut.which) else np.empty(0, np.int32)
                # a document's other words become -1, -2, ...: distinct (text, word) pairs, counted by text
                doc = np.repeat(np.arange(len(texts)), np.diff(cut.first))
                other = np.flatnonzero(numbers < 0)
                pair, place = np.unique(doc[other] * np.int64(len(cut.words) + 1) + cut.which[other], return_inverse=True)
                sizes = np.bincount(pair // (len(cut.words) + 1), minlength=len(texts))
                numbers[other] = -1 - (place - (np.cumsum(sizes) - sizes)[doc[other]])
                rare = [cut.words[k] for k in (pair % (len(cut.words) + 1)).tolist()]
                numbers = [numbers[x:y].tobytes() for x, y in zip(cut.first[:-1].tolist(), cut.first[1:].tolist(), strict=True)]
                words = pa.StructArray.from_arrays([pa.array(rare, pa.string()), pieces.edges(rare)], names=["word", "steps"])
                yield pa.record_batch([
                    batch["doc_id"].slice(lo, len(texts)), batch["text_key"].slice(lo, len(texts)), pa.array(numbers, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), words)],
                    names=["doc_id", "text_key", "numbers", "rare"])

    folded = prepared(rows).mapInArrow(number, NUMBERED).select(
        "doc_id", "text_key", "numbers", F.transform("rare", lambda r: best_path(r["word"], r["steps"], table)).alias("own"))

    def assemble(batches):
        offset, flat = sent_ids.value
        speller = Speller(table) if decoded else None
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(lo, ROWS_AT_ONCE)
                raw = part["numbers"].to_pylist()
                n_words = np.array([len(x) // 4 for x in raw], dtype=np.int64)
                numbers = np.frombuffer(b"".join(raw), dtype=np.int32)
                own = part["own"]
                words = own.flatten()
                sizes = words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                starts, values = np.cumsum(sizes) - sizes, words.flatten().to_numpy(zero_copy_only=False)
                counts = own.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                known = numbers >= 0
                a, size = np.empty(len(numbers), dtype=np.int64), np.empty(len(numbers), dtype=np.int64)
                a[known] = offset[numbers[known]]
                size[known] = offset[numbers[known] + 1] - a[known]
                # -1, -2, ... count from the document's first own word
                mine = np.repeat(np.cumsum(counts) - counts, n_words)[~known] - 1 - numbers[~known]
                a[~known], size[~known] = starts[mine], sizes[mine]
                place, of_known = _gathered(a, size), np.repeat(known, size)
                ids = np.empty(len(place), dtype=np.int32)
                ids[of_known] = flat[place[of_known]]
                ids[~of_known] = values[place[~of_known]]
                ends = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(n_words)))]
                texts = [pa.array([speller.text(ids[x:y]) for x, y in zip(ends[:-1], ends[1:], strict=True)], pa.string())] if decoded else []
                yield pa.record_batch([
                    part["doc_id"], pa.array(n_words), pa.array(np.diff(ends)),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)), part["text_key"], *texts],
                    names=["doc_id", "n_words", "n_pieces", "ids", "text_key", "decoded"][:5 + decoded])

    return folded.mapInArrow(assemble, OUT + (", decoded string" if decoded else ""))


class Speller:
    """Bytes of all pieces in one array, to spell ids by gathering."""

    def __init__(self, table: PieceTable):
        spelled = table.spelled()
        self.flat = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        self.size = np.array([len(x) for x in spelled])
        self.start = np.cumsum(self.size) - self.size

    def text(self, ids: np.ndarray) -> str:
        """The text without the blank put before it."""
        return self.flat[_gathered(self.start[ids], self.size[ids])].tobytes()[1:].decode("utf-8", "replace")


def decode(encoded: DataFrame, table: PieceTable, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``: the text its ids spell."""
    schema = StructType([*encoded.schema.fields, StructField("decoded", StringType())])

    def spell(batches):
        speller, nothing = Speller(table), np.empty(0, np.int32)
        for batch in batches:
            texts = [speller.text(ids.values.to_numpy(zero_copy_only=False) if ids.is_valid else nothing) for ids in batch[ids_col]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return prepared(encoded).mapInArrow(spell, schema)


def round_trip(docs: DataFrame, path: str = MODEL, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_words, n_pieces, ids, exact): exact if the ids decode to the very text."""
    table = PieceTable.load(path)
    return encode(docs, table, frequent=frequent, decoded=True).select(
        "doc_id", "n_words", "n_pieces", "ids", (F.xxhash64("decoded") == F.col("text_key")).alias("exact"))
