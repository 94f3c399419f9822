"""Language identification as multilingual mixture inference.

``learn`` counts character trigrams per language over all training texts
(partial sums per task, one grouped sum). ``identify`` treats each document
as a mixture of the learned languages: expectation-maximisation estimates
the proportions from the trigram likelihoods, and the set of languages grows
one at a time while the penalised likelihood

    log L - penalty * (languages - 1) * log(n_trigrams)

rises. The prediction is the language with the largest proportion.

The model is a matrix of ``BUCKETS`` hashed trigrams by language, of fixed
size per language whatever the corpus. Up to ``MAX_LANGS`` languages it is
sent whole (at most BUCKETS * MAX_LANGS * 8 bytes). With more languages only
the counts above zero are kept, in blocks of buckets of about
``BLOCK_ENTRIES`` counts; the driver makes and a task reads one block at a
time, and the same mixture over all languages is computed from them.

Defined results
* null text or text without a letter: ``und``, score 0, no languages.
* null id: identified, ``held_out`` false. Null lang: not learned from.
* no training text at all: every document is ``und`` with score 0.
* ties between languages: the alphabetically first.
* repeated rows: every input row gives one output row.
* very long texts: cut into pieces of bounded size while counting.
* extra columns: only the id, text and lang columns are read.
* empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, SparkContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import held_out, prepared, stage

BUCKETS = 1 << 16
#: Languages of a model that is sent as one matrix.
MAX_LANGS = 256
#: Counts of a block of a wider model, and distinct trigrams of the texts compared with it at a time.
BLOCK_ENTRIES = 1 << 22
TRIGRAMS_AT_ONCE = 1 << 16
SMOOTHING = 0.25
PENALTY = 4.0
EM_ROUNDS = 12
PIECE_CHARS = 1 << 20

OUT = "doc_id long, held_out boolean, lang_pred string, score double, languages array<string>, proportions array<double>"


@cache
def letters() -> np.ndarray:
    """True for the code points that are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def trigram_counts(text: str) -> np.ndarray:
    """Counts by bucket of the trigrams of lower-cased words; a run of other
    characters counts as one blank."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    for lo in range(0, len(text), PIECE_CHARS):
        code = np.frombuffer(text[lo:lo + PIECE_CHARS + 2].lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ids = trigrams(code)
        if len(ids):
            total += np.bincount(ids, minlength=BUCKETS)
    return total


def trigrams(code: np.ndarray) -> np.ndarray:
    is_letter = letters()[code]
    c = np.where(is_letter, code, 32)
    c = np.concatenate((np.array([32], np.uint32), c, np.array([32], np.uint32)))
    keep = np.ones(len(c), dtype=bool)
    keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
    c = c[keep].astype(np.uint64)
    if len(c) < 3:
        return np.empty(0, dtype=np.int64)
    key = (c[:-2] << np.uint64(42)) | (c[1:-1] << np.uint64(21)) | c[2:]
    key = (key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
    return key.astype(np.int64)


@dataclass
class Model:
    langs: list[str]
    likelihood: np.ndarray  # BUCKETS x languages

    @classmethod
    def of_counts(cls, langs: list[str], counts: np.ndarray) -> Model:
        return cls(langs, ((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * BUCKETS)))

    def sent(self, context: SparkContext) -> Callable[[], Model]:
        """What makes the model in a task."""
        both = context.broadcast((self.langs, self.likelihood))
        return lambda: Model(*both.value)

    def mixtures(self, texts: Iterable[tuple[np.ndarray, np.ndarray]]) -> list[list[tuple[str, float]]]:
        """``mixture`` of every text's distinct trigrams and their counts."""
        # without letters nothing but blanks is left, too few for a trigram
        return [self.mixture(ids, n) if len(ids) and self.langs else [] for ids, n in texts]

    def mixture(self, ids: np.ndarray, n: np.ndarray) -> list[tuple[str, float]]:
        """Chosen languages with their proportions, the largest first."""
        p = self.likelihood[ids]
        return grown(self.langs, n @ np.log(p), em(p, n)[1], lambda chosen: p[:, chosen], n)


@dataclass
class WideModel:
    """Model of any number of languages by its counts above zero. A block holds
    ``width`` buckets: (where each bucket's counts start, languages, counts)."""

    langs: list[str]
    weight: np.ndarray  # per language: sum of its smoothed counts
    blocks: list[Broadcast]
    width: int

    @classmethod
    def of_counted(cls, langs: list[str], counted: DataFrame) -> WideModel:
        entries, at = stage(counted, "language-counts"), {x: i for i, x in enumerate(langs)}
        width = -(-BUCKETS // max(1, min(BUCKETS, -(-entries.count() // BLOCK_ENTRIES))))
        weight, blocks = np.full(len(langs), SMOOTHING * BUCKETS), []
        for lo in range(0, BUCKETS, width):
            rows = list(unpacked(entries.where((F.col("bucket") >= lo) & (F.col("bucket") < lo + width))))
            bucket = np.concatenate([np.empty(0, np.int64), *[b for _, b, _ in rows]])
            lang = np.repeat(np.array([at[x] for x, _, _ in rows], dtype=np.int32), [len(b) for _, b, _ in rows])
            n = np.concatenate([np.empty(0), *[c for _, _, c in rows]])
            order = np.lexsort((lang, bucket))
            weight += np.bincount(lang, n, len(langs))
            blocks.append(counted.sparkSession.sparkContext.broadcast(
                (np.searchsorted(bucket[order], np.arange(lo, lo + width + 1)), lang[order], n[order])))
        return cls(langs, weight, blocks, width)

    def sent(self, context: SparkContext) -> Callable[[], WideModel]:
        both, blocks, width = context.broadcast((self.langs, self.weight)), self.blocks, self.width
        return lambda: WideModel(*both.value, blocks, width)

    def mixtures(self, texts: Iterable[tuple[np.ndarray, np.ndarray]]) -> list[list[tuple[str, float]]]:
        out, some, size = [], [], 0
        for ids, n in texts:
            some.append((ids, n))
            size += len(ids)
            if size >= TRIGRAMS_AT_ONCE:
                out += self.together(some)
                some, size = [], 0
        return out + self.together(some)

    def together(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> list[list[tuple[str, float]]]:
        """Mixtures of a few texts, each block read once."""
        found = [[] for _ in texts]
        for k, block in enumerate(self.blocks):
            first, langs, counts = block.value
            for (ids, _), mine in zip(texts, found, strict=True):
                inside = np.flatnonzero(ids // self.width == k)
                start = first[ids[inside] - k * self.width]
                size = first[ids[inside] - k * self.width + 1] - start
                place = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                mine.append((np.repeat(inside, size), langs[place], counts[place]))
            if len(self.blocks) > 1 and getattr(block, "_path", None):
                del block._value  # read again from its file when needed
        return [self.mixture(ids, n, *map(np.concatenate, zip(*mine, strict=True))) if len(ids) else []
                for (ids, n), mine in zip(texts, found, strict=True)]

    def mixture(self, ids: np.ndarray, n: np.ndarray, row: np.ndarray, lang: np.ndarray, count: np.ndarray) -> list[tuple[str, float]]:
        """``Model.mixture`` from the counts above zero: language ``lang`` has ``count`` of
        trigram ids[row]. A likelihood is (count + SMOOTHING) / weight, so its sums split."""
        total, many = n.sum(), len(self.langs)
        order = np.argsort(lang, kind="stable")
        row, lang, count = row[order], lang[order], count[order]
        single = (np.bincount(lang, n[row] * (np.log(count + SMOOTHING) - np.log(SMOOTHING)), many)
                  + total * (np.log(SMOOTHING) - np.log(self.weight)))
        share = np.full(many, 1.0 / many)
        for _ in range(EM_ROUNDS):
            part = share / self.weight
            over = n / (np.bincount(row, count * part[lang], len(ids)) + SMOOTHING * part.sum())
            share = part * (np.bincount(lang, count * over[row], many) + SMOOTHING * over.sum()) / total

        def columns(chosen: list[int]) -> np.ndarray:
            p = np.full((len(ids), len(chosen)), SMOOTHING)
            for j, k in enumerate(chosen):
                a, b = np.searchsorted(lang, [k, k + 1])
                p[row[a:b], j] += count[a:b]
            return p / self.weight[chosen]

        return grown(self.langs, single, share, columns, n)


def grown(langs: list[str], single: np.ndarray, order: np.ndarray, columns: Callable[[list[int]], np.ndarray],
          n: np.ndarray) -> list[tuple[str, float]]:
    """The set of languages grown from the best ``single`` one by descending ``order``
    while the penalised likelihood rises; ``columns`` gives the likelihoods of languages."""
    price = PENALTY * np.log(n.sum() + 1.0)
    best = int(np.argmax(single))
    chosen, share, level = [best], np.ones(1), single[best]
    for other in [k for k in np.argsort(-order, kind="stable").tolist() if k != best]:
        trial, weights = em(columns([*chosen, other]), n)
        if trial - price * len(chosen) <= level - price * (len(chosen) - 1):
            break
        chosen.append(other)
        share, level = weights, trial
    return sorted(((langs[k], float(s)) for k, s in zip(chosen, share, strict=True)), key=lambda x: (-x[1], x[0]))


def em(p: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """Log likelihood and proportions of a mixture: likelihoods p (trigram x
    language), trigram counts n."""
    total, share = n.sum(), np.full(p.shape[1], 1.0 / p.shape[1])
    for _ in range(EM_ROUNDS):
        joint = p * share
        share = (n / joint.sum(axis=1)) @ joint / total
    return float(n @ np.log(p @ share)), share


def unpacked(counted: DataFrame) -> Iterable[tuple[str, np.ndarray, np.ndarray]]:
    """(lang, buckets, counts) of the rows of ``counted``, packed per batch and language for the driver."""

    def pack(batches):
        for batch in batches:
            lang = batch["lang"].dictionary_encode()
            code, bucket, n = lang.indices.to_numpy(), batch["bucket"].to_numpy(), batch["n"].to_numpy()
            order = np.argsort(code, kind="stable")
            ends = np.cumsum(np.bincount(code, minlength=len(lang.dictionary)))[:-1]
            split = lambda x, kind: pa.array([y.astype(kind).tobytes() for y in np.split(x[order], ends)], pa.binary())
            yield pa.record_batch([lang.dictionary, split(bucket, np.uint16), split(n, np.int64)], names=["lang", "buckets", "n"])

    rows = prepared(counted).mapInArrow(pack, "lang string, buckets binary, n binary").toArrow()
    for lang, bucket, n in zip(*(rows[x].to_pylist() for x in ("lang", "buckets", "n")), strict=True):
        yield lang, np.frombuffer(bucket, np.uint16).astype(np.int64), np.frombuffer(n, np.int64).astype(float)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | WideModel:
    """Trigram model of the documents that are not held out."""
    train = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
             .where("doc_id is not null and text is not null and lang is not null").where(~held_out(F.col("doc_id")))
             .select("lang", "text"))

    def count(batches):
        sums: dict[str, np.ndarray] = {}

        def rows():
            for lang, total in sums.items():
                b = np.flatnonzero(total)
                yield pa.record_batch([pa.array([lang] * len(b), pa.string()), pa.array(b), pa.array(total[b])],
                                      names=["lang", "bucket", "n"])

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                if lang not in sums:
                    if len(sums) >= MAX_LANGS:  # pass on what is counted so far
                        yield from rows()
                        sums.clear()
                    sums[lang] = np.zeros(BUCKETS, dtype=np.int64)
                sums[lang] += trigram_counts(text)
        yield from rows()

    counted = (prepared(train).mapInArrow(count, "lang string, bucket long, n long")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    names = sorted(r[0] for r in train.select("lang").distinct().collect())
    if len(names) > MAX_LANGS:
        return WideModel.of_counted(names, counted)
    matrix = np.zeros((BUCKETS, len(names)))
    at = {x: i for i, x in enumerate(names)}
    for lang, bucket, n in unpacked(counted):
        matrix[bucket, at[lang]] = n
    return Model.of_counts(names, matrix)


def identify(docs: DataFrame, model: Model | WideModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Language mixture of every row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                       F.col(text_col).alias("text"))
    load = model.sent(docs.sparkSession.sparkContext)

    def counts(text):
        text = text or ""
        if len(text) < PIECE_CHARS:
            code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            ids, n = np.unique(trigrams(code), return_counts=True)
        else:
            total = trigram_counts(text)
            ids = np.flatnonzero(total)
            n = total[ids]
        return ids, n.astype(float)

    def predict(batches):
        m = load()
        for batch in batches:
            found = m.mixtures(counts(text) for text in batch["text"].to_pylist())
            yield pa.record_batch([
                batch["doc_id"], batch["held_out"],
                pa.array([f[0][0] if f else "und" for f in found], pa.string()),
                pa.array([f[0][1] if f else 0.0 for f in found], pa.float64()),
                pa.array([[x for x, _ in f] for f in found], pa.list_(pa.string())),
                pa.array([[p for _, p in f] for f in found], pa.list_(pa.float64())),
            ], names=["doc_id", "held_out", "lang_pred", "score", "languages", "proportions"])

    return prepared(rows).mapInArrow(predict, OUT)
