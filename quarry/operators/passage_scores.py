"""All queries scored against a passage by the task that holds it.

The forward table keeps a passage's counted terms in one row, so the sum of a
(query, passage) pair needs no shuffle: a batch of passages is matched with the
query terms, the matches are expanded to (passage, query) cells, and every
cell's sum is one ``bincount``. Only the pairs leave the task. The formulas are
those of ``operators.scoring``.

The query side is sent to the tasks: it is taken only when its rows are within the
broadcast bound, and a batch has at most ``CELLS`` cells (one passage at least).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Passages and cells (passages x queries) worked on at a time.
PASSAGES = 512
CELLS = 1 << 21


@dataclass
class QuerySide:
    """Query terms as posting lists: term t stands in the queries ``qno[first[t]:first[t + 1]]``,
    ``k`` times each. ``known`` marks index terms, ``df`` and ``bg`` are theirs."""

    qids: pa.Array
    ql: np.ndarray
    terms: pa.Array
    first: np.ndarray
    qno: np.ndarray
    k: np.ndarray
    known: np.ndarray
    df: np.ndarray
    bg: np.ndarray
    stats: dict
    k1: float
    k2: float
    b: float
    epsilon: float
    mu: float

    @classmethod
    def of(cls, rows: pa.Table, freq: pa.Table, stats: dict, params) -> QuerySide:
        """``rows``: (qid, ql, term, k), one ql per qid; ``freq``: (term, df, stat) of the query terms in the index."""
        rows = rows.sort_by("term").combine_chunks()
        qids = pc.unique(rows["qid"]).combine_chunks() if isinstance(pc.unique(rows["qid"]), pa.ChunkedArray) else pc.unique(rows["qid"])
        qno = pc.index_in(rows["qid"], value_set=qids).to_numpy().astype(np.int64)
        ql = np.zeros(len(qids))
        ql[qno] = rows["ql"].to_numpy()
        term = rows["term"].to_numpy()
        first = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1]))) if len(term) else np.empty(0, np.int64)
        terms = pa.array(term[first], rows["term"].type)
        at = pc.index_in(terms, value_set=freq["term"].combine_chunks()).to_numpy(zero_copy_only=False) if freq.num_rows else np.full(len(terms), np.nan)
        known = ~np.isnan(at.astype(float))
        df, stat = np.ones(len(terms)), np.ones(len(terms))
        df[known] = freq["df"].to_numpy()[at[known].astype(np.int64)]
        stat[known] = freq["stat"].to_numpy()[at[known].astype(np.int64)]
        return cls(qids, ql, terms, np.append(first, len(term)), qno, rows["k"].to_numpy().astype(float), known, df,
                   params.mu * stat / max(float(stats["total_words"]), 1.0), stats, params.k1, params.k2, params.b, params.epsilon, params.mu)

    def of_query(self, per_entry: np.ndarray) -> np.ndarray:
        """Sums of a value of every (term, query) entry by query."""
        return np.bincount(self.qno, weights=per_entry, minlength=len(self.qids))

    def by_entry(self, per_term: np.ndarray) -> np.ndarray:
        return np.repeat(per_term, np.diff(self.first))


class _Matches:
    """(passage, query) cells met by the terms of a batch; ``t``, ``d``, ``n``: term, passage and count."""

    def __init__(self, q: QuerySide, words: pa.ListArray, counts: pa.ListArray):
        size = np.diff(np.asarray(words.offsets))
        at = pc.index_in(words.flatten(), value_set=q.terms)
        hit = np.flatnonzero(pc.is_valid(at).to_numpy(zero_copy_only=False))
        t = at.take(pa.array(hit)).to_numpy(zero_copy_only=False).astype(np.int64)
        d, n = np.repeat(np.arange(len(size)), size)[hit], counts.flatten().to_numpy(zero_copy_only=False)[hit].astype(float)
        wide = q.first[t + 1] - q.first[t]
        start = np.cumsum(wide) - wide
        self.entry = np.arange(int(wide.sum())) + np.repeat(q.first[t] - start, wide)
        self.t, self.d, self.n = np.repeat(t, wide), np.repeat(d, wide), np.repeat(n, wide)
        self.cell = self.d * len(q.qids) + q.qno[self.entry]

    def sums(self, values: np.ndarray, cells: int) -> np.ndarray:
        return np.bincount(self.cell, weights=values, minlength=cells)


def scores_of(q: QuerySide, batch: pa.RecordBatch, names: list[str]) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """(passage, query, scores by name) of the batch's pairs that share a raw query token with the index terms."""
    n_q, s = len(q.qids), q.stats
    cells = batch.num_rows * n_q
    idx = _Matches(q, batch["terms"], batch["tf"])
    pair = np.zeros(cells, bool)
    pair[idx.cell] = True
    pair = np.flatnonzero(pair)
    doc, qno = pair // n_q, pair % n_q
    out: dict[str, np.ndarray] = {}
    k, n = q.k, float(s["n_passages"])
    if "tfidf_cosine" in names:
        weight = np.where(q.by_entry(q.known), k / q.ql[q.qno] * np.log10(float(s["n_nonempty"]) / q.by_entry(q.df)), 0.0)
        wc = batch["word_count"].to_numpy().astype(float)
        wd = idx.n / wc[idx.d] * np.log10(n / q.df[idx.t])
        dot = idx.sums(k[idx.entry] * weight[idx.entry] * wd, cells)[pair]
        norm = np.sqrt(q.of_query(k * weight ** 2))[qno] * np.nan_to_num(batch["pnorm"].to_numpy(zero_copy_only=False).astype(float))[doc]
        out["tfidf_cosine"] = np.divide(dot, norm, out=np.zeros(len(pair)), where=norm != 0)
    if set(names) - {"tfidf_cosine"}:
        raw, dl = _Matches(q, batch["raw"], batch["f"]), batch["dl"].to_numpy().astype(float)
        rk, rl, known = k[raw.entry], dl[raw.d], q.known[raw.t]
    if "bm25" in names:
        idf = np.where(q.known, np.log(np.maximum(n - q.df + 0.5, 1e-300) / (q.df + 0.5)), 0.0)
        w = k * q.by_entry(idf) * (k * (q.k2 + 1) / (q.k2 + k))
        part = raw.n * (q.k1 + 1) / (q.k1 * (1 - q.b + q.b * rl / float(s["avdl"])) + raw.n)
        out["bm25"] = raw.sums(w[raw.entry] * part, cells)[pair]
    if "laplace" in names:
        out["laplace"] = raw.sums(rk * np.log(raw.n + 1.0), cells)[pair] - q.ql[qno] * np.log(dl[doc] + float(s["vocabulary_size"]))
    if "lidstone" in names:
        eps = q.epsilon
        hit = raw.sums(rk * (np.log(raw.n / rl + eps) - np.log(eps)), cells)[pair]
        out["lidstone"] = hit + q.ql[qno] * (np.log(eps) - np.log(dl[doc] + eps * float(s["vocabulary_size"])))
    if "dirichlet" in names:
        on, bg = q.by_entry(q.known), q.by_entry(q.bg)
        a, b = q.of_query(np.where(on, k * np.log(bg), 0.0)), q.of_query(np.where(on, k, 0.0))
        hit = raw.sums(np.where(known, rk * (np.log(raw.n + q.bg[raw.t]) - np.log(q.bg[raw.t])), 0.0), cells)[pair]
        out["dirichlet"] = a[qno] - b[qno] * np.log(dl[doc] + q.mu) + hit
    return doc, qno, out


def query_terms_task(sent, lists: list[tuple[str, str]]):
    """Task: forward rows whose ``lists`` (words, counts) keep the query terms only, all that a score reads of them."""

    def run(batches):
        terms = sent.value.terms
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            for words, counts in lists:
                flat, offsets = columns[words].flatten(), np.asarray(columns[words].offsets)
                kept = pc.is_in(flat, value_set=terms)
                before = np.concatenate(([0], np.cumsum(kept.to_numpy(zero_copy_only=False))))
                ends = pa.array(before[offsets - offsets[0]].astype(np.int32))
                columns[words], columns[counts] = (pa.ListArray.from_arrays(ends, x.filter(kept)) for x in (flat, columns[counts].flatten()))
            yield pa.record_batch(list(columns.values()), names=batch.schema.names)

    return run


def score_task(sent, names: list[str], labels: bool):
    """Task: forward rows (and, with ``labels``, ``_hits`` and ``_good``) to (qid, pid, ord, *names) rows."""

    def run(batches):
        q = sent.value
        n_q = len(q.qids)
        step = max(1, min(PASSAGES, CELLS // max(n_q, 1)))
        for whole in batches:
            for lo in range(0, whole.num_rows, step):
                batch = whole.slice(lo, step)
                doc, qno, out = scores_of(q, batch, names)
                at = pa.array(doc)
                columns = [q.qids.take(pa.array(qno)), batch["pid"].take(at), batch["ord"].take(at), *[pa.array(out[x]) for x in names]]
                if labels:
                    hits = batch["_hits"]
                    owner = np.repeat(np.arange(batch.num_rows), pc.fill_null(pc.list_value_length(hits), 0).to_numpy(zero_copy_only=False))
                    found = pc.index_in(hits.flatten(), value_set=q.qids).to_numpy(zero_copy_only=False).astype(float)
                    hit = np.zeros(batch.num_rows * n_q, bool)
                    ok = ~np.isnan(found)
                    hit[owner[ok] * n_q + found[ok].astype(np.int64)] = True
                    hit = hit[doc * n_q + qno]
                    good = batch["_good"].to_numpy(zero_copy_only=False)[doc]
                    columns += [pa.array(hit.astype(float)), pa.array(np.where(hit, 2.0, np.where(good, 1.0, 0.0)))]
                yield pa.record_batch(columns, names=["qid", "pid", "ord", *names, *(["relevancy", "grade"] if labels else [])])

    return run
