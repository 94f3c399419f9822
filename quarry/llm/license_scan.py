"""Licence scan with a positional rare-token index.

``TEMPLATES`` is a small table of licence phrases. Its words form an index
word -> (template, position). ``document_frequencies`` counts in how many
documents of the whole corpus each licence word occurs; ``scan`` looks up the
rare ones of a file:

1. the rarest word of every mandatory key phrase (its anchor), wherever it
   occurs, and the file's ``TOP_WORDS`` licence words of highest IDF among
   those in at most ``COMMON_SHARE`` of the documents;
2. each place p of such a word, with a posting (template, q), supports the
   template at offset p - q; supports with the same offset are intersected;
3. a supported offset counts if a mandatory key phrase stands there word for
   word; its coverage is the IDF share of the template's words that match.

Since the anchor of every key phrase is always looked up, no place of a key
phrase is lost, however common its words are. The base phrases are templates
that consist of their key phrase alone. The index and its frequencies are as
small as the template table, whatever the corpus; documents are scanned where
they are read, without a shuffle.

Defined results
* null text: as empty: no words, no places, score 0. Null id: scanned.
* very long texts: only the places of licence words are kept, not the words' lists.
* ties: equal IDF is ordered by word; equal places count once per phrase.
* repeated rows: every input row gives one output row and counts in the frequencies.
* extra columns: only the id and text are read. Empty table: no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import prepared

WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOP_WORDS = 8
COMMON_SHARE = 0.1
MIN_COVERAGE = 0.6


@dataclass(frozen=True)
class Template:
    label: str
    key: str  # mandatory phrase, part of the text
    text: str
    base: bool = False


# Base phrases with their labels, then notices of public licences.
TEMPLATES = (
    Template("cc-by", "cc by", "cc by", True),
    Template("gpl", "general public license", "general public license", True),
    Template("reserved", "all rights reserved", "all rights reserved", True),
    Template("apache-2.0", "apache license", "licensed under the apache license version 2 0"),
    Template("mit", "mit license", "released under the mit license"),
    Template("mit", "permission is hereby granted free of charge",
             "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("gpl-3.0", "gnu general public license version 3", "licensed under the gnu general public license version 3"),
    Template("gpl-2.0", "gnu general public license version 2", "licensed under the gnu general public license version 2"),
    Template("lgpl", "gnu lesser general public license", "licensed under the gnu lesser general public license"),
    Template("agpl", "gnu affero general public license", "licensed under the gnu affero general public license"),
    Template("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    Template("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    Template("cc0", "cc0 1 0 universal", "cc0 1 0 universal"),
    Template("bsd", "redistribution and use in source and binary forms",
             "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("mpl-2.0", "mozilla public license", "subject to the terms of the mozilla public license v 2 0"),
    Template("unlicense", "released into the public domain",
             "this is free and unencumbered software released into the public domain"),
    Template("proprietary", "proprietary and confidential", "proprietary and confidential"),
)

OUT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
       "labels string, score double, templates array<struct<label string, start long, coverage double>>")


def tokens(text: str | None) -> list[bytes]:
    return WORDS.findall((text or "").encode("utf-8", "surrogatepass").lower())


def vocabulary(templates: tuple[Template, ...] = TEMPLATES) -> set[bytes]:
    return {w for t in templates for w in tokens(t.text)}


def document_frequencies(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES,
                         text_col: str = "text") -> tuple[int, dict[bytes, int]]:
    """(documents, documents with each licence word), over the whole table."""
    words = vocabulary(templates)

    def count(batches):
        seen, n = Counter(), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                n += 1
                seen.update(words.intersection(tokens(text)))
        # one row per licence word and task
        yield pa.record_batch([pa.array([w.decode() for w in seen] + [None], pa.string()),
                               pa.array([*seen.values(), n], pa.int64())], names=["word", "n"])

    rows = prepared(docs.select(text_col)).mapInArrow(count, "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r[0]: r[1] for r in rows}
    total = found.pop(None, 0)
    return total, {w.encode(): n for w, n in found.items()}


class RareTokenIndex:
    """Positional postings of the templates, with corpus IDF."""

    def __init__(self, total: int, frequency: dict[bytes, int], templates: tuple[Template, ...] = TEMPLATES):
        self.templates = templates
        self.words = [tokens(t.text) for t in templates]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, ws in enumerate(self.words):
            for q, w in enumerate(ws):
                self.postings[w].append((t, q))
        self.idf = {w: math.log((total + 1) / (frequency.get(w, 0) + 0.5)) + 1e-9 for w in self.postings}
        self.common = {w for w in self.postings if frequency.get(w, 0) > COMMON_SHARE * total}
        self.keys, self.anchors = [], set()
        for t, tpl in enumerate(templates):
            key, ws = tokens(tpl.key), self.words[t]
            at = next(i for i in range(len(ws)) if ws[i:i + len(key)] == key)
            self.keys.append((at, len(key)))
            self.anchors.add(min(key, key=self.rarity))

    def rarity(self, word: bytes) -> tuple[float, bytes]:
        return -self.idf[word], word

    def looked_up(self, present: set[bytes]) -> list[bytes]:
        """The words of a file that are looked up, the rarest first."""
        rare = sorted(present - self.common, key=self.rarity)[:TOP_WORDS]
        return sorted({*rare, *(present & self.anchors)}, key=self.rarity)

    def matches(self, places: dict[bytes, list[int]]) -> list[tuple[int, int, float]]:
        """(template, offset, coverage) of the supported and verified offsets."""
        offsets = {(t, p - q) for w in self.looked_up(set(places)) for p in places[w] for t, q in self.postings[w]}
        at = {w: set(ps) for w, ps in places.items()} if offsets else {}
        none: set[int] = set()
        out = []
        for t, o in sorted(offsets):
            ws, (k, size) = self.words[t], self.keys[t]
            if all(o + q in at.get(ws[q], none) for q in range(k, k + size)):
                whole = sum(self.idf[w] for w in ws)
                hit = sum(self.idf[w] for q, w in enumerate(ws) if o + q in at.get(w, none))
                out.append((t, o, hit / whole))
        return out


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Licence phrases and labels of every row of ``docs``."""
    total, frequency = document_frequencies(docs, templates, text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def find(batches):
        index = RareTokenIndex(total, frequency, templates)
        words = index.postings
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ws = tokens(text)
                places: dict[bytes, list[int]] = {}
                for w in words.keys() & set(ws):
                    places[w] = []
                if places:
                    for i, w in enumerate(ws):
                        if w in places:
                            places[w].append(i)
                found = index.matches(places)
                base = [(t, o) for t, o, _ in found if templates[t].base]
                good = [(t, o, c) for t, o, c in found if c >= MIN_COVERAGE]
                out.append({
                    "doc_id": doc_id, "n_words": len(ws), "n_base": len(base),
                    "first_word": min((o for _, o in base), default=None),
                    "last_word": max((o for _, o in base), default=None),
                    "base_labels": ",".join(sorted({templates[t].label for t, _ in base})),
                    "labels": ",".join(sorted({templates[t].label for t, _, _ in good})),
                    "score": min(1.0, max((c for _, _, c in good), default=0.0)),
                    "templates": [{"label": templates[t].label, "start": o + index.keys[t][0], "coverage": c}
                                  for t, o, c in good],
                })
            yield pa.RecordBatch.from_pylist(out, schema=SCHEMA)

    return prepared(rows).mapInArrow(find, OUT)


SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("templates", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("coverage", pa.float64())])))])
