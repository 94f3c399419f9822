"""Exact n-gram Jaccard self-join with set-relation skipping.

A document's set holds its distinct 5-word shingles. Two documents link when
|A & B| / |A | B| >= 0.8, that is when the symmetric difference D(A, B) is at
most (|A| + |B|) / 9. The join is exact; it returns the connected components
of all links without listing the pairs of a group.

1. ``shingle_sets``: per document its size, a fingerprint of the set, a
   512-bit parity map (the popcount of two maps' XOR never exceeds D) and the
   prefix that the join bound requires, under a global order that puts
   shingles of many documents last and sorts the rest by hash. Equal
   fingerprints are one class; the smallest document stands for it.
2. Index lists: shingle -> members, cut into blocks by size level. Only
   neighbouring levels can link, so the other blocks of a list are skipped;
   inside, members are skipped by position (too few shingles remain behind
   this place to reach the required overlap) and by parity map.
3. Index-level relation: each member is checked against the smallest member
   of its block and of the block below only. Links found hang a document under a
   *head*, with the exact D to it, and join components.
4. Lists that still span several components. The members of a list of up to
   ``SHORT`` are paired where component, size and position allow. A longer list is cut
   into blocks of about ``BLOCK`` members, and blocks meet: inside a meeting the same
   tests and the parity map are applied as arrays, and only pairs that pass
   leave it. A list of any length is spread over many meetings, and members
   that share a passage and little else are never listed as pairs.
5. Answer-level relation: the answer of a pair (x, z) is derived from the
   answer of their heads: D(x, z) lies within D(hx, hz) +- (D(x, hx) +
   D(z, hz)). Only pairs this cannot decide are verified one by one.

Pairs inside a component are never formed: they cannot change the result.
Which shingles count as frequent is estimated on a sixteenth of the documents
and sent as at most ``HOT_LIMIT`` hashes. It changes the order only: the
prefix bound holds under any order, so the result stays exact.

Sets are compared through 64-bit shingle hashes; classes through 128 bits.

Defined results
* null text or text without words: empty set, 0 shingles, linked with nothing,
  its own component.
* fewer than five words: the whole sequence is one shingle.
* null id: counted (n_shingles), component null; never linked.
* repeated rows: rows of one id are one node, whatever their texts.
* ties: the smallest id names a component.
* very long texts: hashing works on bounded pieces; one document's set is held by one task.
* extra columns: only id and text are read. Empty table: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACE, U64, components, groups, mix, prepared, rolling, stage, words_of

SHINGLE = 5
SAMPLE = 16
HOT_SEEN = 2
HOT_LIMIT = 500_000
# Beyond so many ids the texts of candidates are found by a shuffled join.
BROADCAST_IDS = 1_000_000
MAPS = [f"m{i}" for i in range(8)]
# Members of an index list that are paired one by one (so rows grow by a bounded
# factor), and members of a block of a longer list.
SHORT = 32
BLOCK = 256

SETS = ("doc_id long, n long, level int, f1 long, f2 long, " + ", ".join(f"{m} long" for m in MAPS)
        + ", prefix array<long>")


def size_levels(limit: int = 1 << 40) -> np.ndarray:
    """Lower bounds of the size levels: sets that link lie in one level or in neighbours."""
    bounds = [1]
    while bounds[-1] < limit:
        bounds.append(max(bounds[-1] + 1, -(-bounds[-1] * 5 // 4)))
    return np.array(bounds)


LEVELS = size_levels()


def shingles(hashes: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a word sequence."""
    if not len(hashes):
        return np.empty(0, dtype=U64)
    return np.unique(rolling(hashes, min(width, len(hashes))))


def _sets_of(texts, width):
    for lo, hi in groups(texts):
        w = words_of(texts[lo:hi], SPACE, lower=True)
        for i in range(hi - lo):
            yield lo + i, shingles(w.hash[w.first[i]:w.first[i + 1]], width)


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set of hashes, as two signed numbers."""
    m = mix(s)
    two = np.array([m.sum(dtype=U64), np.bitwise_xor.reduce(mix(m ^ U64(0x2545F4914F6CDD1D))) if len(s) else U64(0)], U64).view(np.int64)
    return int(two[0]), int(two[1])


def _signed(x) -> pa.Array:
    return pa.array(np.ascontiguousarray(x, dtype=U64).view(np.int64))


def frequent_shingles(docs: DataFrame, width: int = SHINGLE) -> np.ndarray:
    """Hashes of shingles seen repeatedly in a sample of the documents, the
    most frequent ``HOT_LIMIT`` at most, sorted."""

    def explode(batches):
        for batch in batches:
            found = [s for _, s in _sets_of(batch.column(0).to_pylist(), width)]
            yield pa.record_batch([_signed(np.concatenate([np.empty(0, U64), *found]))], names=["s"])

    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0).select("text")
    top = (prepared(sample).mapInArrow(explode, "s long").groupBy("s").count().where(F.col("count") >= HOT_SEEN)
           .orderBy(F.desc("count"), "s").limit(HOT_LIMIT).select("s"))
    return np.sort(top.toPandas()["s"].to_numpy(dtype=np.int64).view(U64))


def shingle_sets(docs: DataFrame, hot: np.ndarray, width: int = SHINGLE) -> DataFrame:
    """Size, level, fingerprint, parity map and prefix of every document's set."""
    sent = docs.sparkSession.sparkContext.broadcast(hot)

    def describe(batches):
        frequent = sent.value
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            n, prints, maps, prefixes = [], [], [], []
            for _, s in _sets_of(batch["text"].to_pylist(), width):
                n.append(len(s))
                m = mix(s)
                prints.append(fingerprint(s))
                bit = np.bincount((m >> U64(55)).astype(np.int64), minlength=512) & 1
                maps.append(np.packbits(bit.astype(np.uint8), bitorder="little").view(np.int64))
                size = len(s) - -(-4 * len(s) // 5) + 1 if len(s) else 0
                if len(frequent) and len(s):
                    at = np.searchsorted(frequent, s)
                    is_hot = frequent[np.minimum(at, len(frequent) - 1)] == s
                    s = np.concatenate((s[~is_hot], s[is_hot]))
                prefixes.append(s[:size].view(np.int64))
            grid = np.array(maps, dtype=np.int64).reshape(-1, 8)
            f = np.array(prints, dtype=np.int64).reshape(-1, 2)
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()),
                 pa.array((np.searchsorted(LEVELS, n, "right") - 1).astype(np.int32)), pa.array(np.ascontiguousarray(f[:, 0])), pa.array(np.ascontiguousarray(f[:, 1])),
                 *[pa.array(np.ascontiguousarray(grid[:, k])) for k in range(8)],
                 pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(p) for p in prefixes]))).astype(np.int32)),
                                          pa.array(np.concatenate([np.empty(0, np.int64), *prefixes])))],
                names=["doc_id", "n", "level", "f1", "f2", *MAPS, "prefix"])

    return prepared(docs).select("doc_id", "text").mapInArrow(describe, SETS)


def index_lists(classes: DataFrame) -> DataFrame:
    """(token, c, n, rest, level) of the prefix shingles that two classes
    or more have; rest = shingles of the class from this place on."""
    rows = (classes.select("c", F.posexplode("prefix").alias("pos", "token"), "n", "level")
            .select("token", "c", "n", (F.col("n") - F.col("pos")).alias("rest"), "level"))
    alive = rows.groupBy("token").agg((F.min("c") < F.max("c")).alias("alive")).where("alive").select("token")
    return stage(rows.join(alive, "token"), "jaccard-lists")


def _fits(n_a, rest_a, n_b, rest_b):
    """Size and position bounds of a pair at a common shingle."""
    return ((5 * F.least(n_a, n_b) >= 4 * F.greatest(n_a, n_b))
            & (9 * F.least(rest_a, rest_b) >= 4 * (n_a + n_b)) )


def near_by_map(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes whose parity maps do not rule a link out."""
    left = classes.select(F.col("c").alias("a"), F.col("n").alias("na"), F.array(*MAPS).alias("ma"))
    right = classes.select(F.col("c").alias("b"), F.col("n").alias("nb"), F.array(*MAPS).alias("mb"))
    differ = sum((F.bit_count(F.col("ma")[k].bitwiseXOR(F.col("mb")[k])) for k in range(8)), F.lit(0))
    return (pairs.join(left, "a").join(right, "b")
            .where((5 * F.least("na", "nb") >= 4 * F.greatest("na", "nb")) & (9 * differ <= F.col("na") + F.col("nb")))
            .select("a", "b", "na", "nb"))


def candidate_sets(docs: DataFrame, wanted: DataFrame, width: int = SHINGLE, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """(c, s) with the packed sorted shingle hashes of the classes ``wanted`` (c, doc_id, f1, f2)."""
    small = broadcast_ids and wanted.limit(broadcast_ids + 1).count() <= broadcast_ids
    rows = docs.join(F.broadcast(wanted) if small else wanted, "doc_id").select("c", "f1", "f2", "text")

    def pack(batches):
        for batch in batches:
            found, ok = [], []
            prints = zip(batch["f1"].to_pylist(), batch["f2"].to_pylist(), strict=True)
            for (_, s), want in zip(_sets_of(batch["text"].to_pylist(), width), prints, strict=True):
                ok.append(len(s) > 0 and fingerprint(s) == want)  # another text may have the same id
                found.append(s.tobytes())
            yield pa.record_batch([batch["c"], pa.array(found, pa.binary())], names=["c", "s"]).filter(pa.array(ok, pa.bool_()))

    return prepared(rows).mapInArrow(pack, "c long, s binary")


def differences(pairs: DataFrame, docs: DataFrame, classes: DataFrame, width: int = SHINGLE, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """Exact symmetric difference ``d`` of the pairs of classes (a, b, na, nb)."""
    ids = pairs.select(F.col("a").alias("c")).union(pairs.select(F.col("b").alias("c"))).distinct()
    wanted = stage(ids.join(classes.select("c", F.col("rep").alias("doc_id"), "f1", "f2"), "c"), "jaccard-ids")
    sets = stage(candidate_sets(docs, wanted, width, broadcast_ids).dropDuplicates(["c"]), "jaccard-sets")
    rows = (pairs.join(sets.select(F.col("c").alias("a"), F.col("s").alias("sa")), "a")
            .join(sets.select(F.col("c").alias("b"), F.col("s").alias("sb")), "b"))

    def compare(batches):
        for batch in batches:
            d = []
            for x, y in zip(batch["sa"], batch["sb"], strict=True):
                x, y = np.frombuffer(x.as_buffer(), dtype=U64), np.frombuffer(y.as_buffer(), dtype=U64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                d.append(len(x) + len(y) - 2 * both)
            yield pa.record_batch([batch["a"], batch["b"], batch["na"], batch["nb"], pa.array(d, pa.int64())],
                                  names=["a", "b", "na", "nb", "d"])

    return prepared(rows).select("a", "b", "na", "nb", "sa", "sb").mapInArrow(
        compare, "a long, b long, na long, nb long, d long")


LINK = "9 * d <= na + nb"


def cross_pairs(open_lists: DataFrame, classes: DataFrame, short: int = SHORT, block: int = BLOCK) -> DataFrame:
    """(a, b, na, nb): pairs of classes of different components that meet in a list
    and that size, position and parity map do not rule out. ``open_lists``:
    (token, c, n, rest, level, component)."""
    size = open_lists.groupBy("token").agg(F.count("*").alias("members"))
    sized = stage(open_lists.join(size, "token"), "jaccard-sized")
    mine = sized.where(F.col("members") <= short).drop("members")
    other = mine.select("token", *[F.col(c).alias(f"{c}_") for c in mine.columns if c != "token"])
    pairs = (mine.join(other, "token").where("(level = level_ and c > c_) or level = level_ + 1").where("component <> component_")
             .where(_fits(F.col("n"), F.col("rest"), F.col("n_"), F.col("rest_")))
             .select(F.greatest("c", "c_").alias("a"), F.least("c", "c_").alias("b")))
    near = near_by_map(pairs.distinct(), classes)
    long = sized.where(F.col("members") > short).drop("members")
    if not long.limit(1).count():
        return near
    return near.union(met_pairs(long, classes, block)).distinct()


def met_pairs(open_lists: DataFrame, classes: DataFrame, block: int = BLOCK) -> DataFrame:
    """``cross_pairs`` of long lists, by meetings of their blocks."""
    size = open_lists.groupBy("token", "level").agg(F.ceil(F.count("*") / block).alias("k"))
    member = F.struct("c", "n", "rest", "component", *MAPS)
    blocks = (open_lists.join(classes.select("c", *MAPS), "c").join(size, ["token", "level"])
              .groupBy("token", "level", F.pmod(F.xxhash64("c"), "k").alias("blk")).agg(F.collect_list(member).alias("t")))
    blocks = stage(blocks.select("token", "level", "blk", *[F.col(f"t.{x}").alias(x) for x in ["c", "n", "rest", "component", *MAPS]]), "jaccard-blocks")
    names = ["c", "n", "rest", "component", *MAPS]
    left = blocks.select("token", "level", "blk", *[F.col(x).alias(f"{x}_a") for x in names])
    right = blocks.select("token", F.col("level").alias("level_b"), F.col("blk").alias("blk_b"), *[F.col(x).alias(f"{x}_b") for x in names])

    def meet(batches):
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                get = lambda x: batch[x][i].values.to_numpy(zero_copy_only=False)  # noqa: B023, E731
                na, nb, ra, rb = get("n_a")[:, None], get("n_b")[None, :], get("rest_a")[:, None], get("rest_b")[None, :]
                ok = ((5 * np.minimum(na, nb) >= 4 * np.maximum(na, nb)) & (9 * np.minimum(ra, rb) >= 4 * (na + nb))
                      & (get("component_a")[:, None] != get("component_b")[None, :]))
                x, y = np.nonzero(ok)
                differ = sum(np.bitwise_count(get(f"{m}_a").view(U64)[x] ^ get(f"{m}_b").view(U64)[y]).astype(np.int64) for m in MAPS)
                near = 9 * differ <= na[x, 0] + nb[0, y]
                out.append(np.stack([get("c_a")[x[near]], get("c_b")[y[near]], na[x[near], 0], nb[0, y[near]]], 1))
            found = np.concatenate(out) if out else np.empty((0, 4), np.int64)
            flip = found[:, 0] < found[:, 1]
            found[flip] = found[flip][:, [1, 0, 3, 2]]
            yield pa.record_batch([pa.array(np.ascontiguousarray(found[:, k])) for k in range(4)], names=["a", "b", "na", "nb"])

    columns = [f"{x}_{side}" for side in "ab" for x in names]
    met = left.join(right, "token").where("(level = level_b and blk <= blk_b) or level = level_b + 1").select(*columns)
    return prepared(met).mapInArrow(meet, "a long, b long, na long, nb long").distinct()


def join_classes(docs: DataFrame, classes: DataFrame, given: DataFrame, width: int = SHINGLE,
                 broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """Links (a, b) between classes that, with the edges ``given``, connect all
    classes that any chain of links and given edges connects."""
    lists = index_lists(classes)
    low = lists.groupBy("token", "level").agg(F.min(F.struct("c", "n", "rest")).alias("p"))
    # the block's own smallest member, and that of the block one level below
    heads = low.select("token", "level", "p").union(low.select("token", (F.col("level") + 1).alias("level"), "p"))
    star = (lists.join(heads, ["token", "level"]).where(F.col("c") != F.col("p.c"))
            .where(_fits(F.col("n"), F.col("rest"), F.col("p.n"), F.col("p.rest")))
            .select(F.greatest("c", "p.c").alias("a"), F.least("c", "p.c").alias("b")).distinct())
    first = stage(differences(stage(near_by_map(star, classes), "jaccard-star"), docs, classes, width, broadcast_ids), "jaccard-first")
    links = first.where(LINK).select("a", "b").union(given)
    # head of a class: the smallest class it links with so far, with the exact difference
    head = first.where(LINK).groupBy("a").agg(F.min(F.struct("b", "d")).alias("h")).select(
        F.col("a").alias("c"), F.col("h.b").alias("head"), F.col("h.d").alias("dh"))
    comp = components(links).withColumnRenamed("node", "c")
    known = stage(classes.select("c").join(comp, "c", "left").join(head, "c", "left").select(
        "c", F.coalesce("component", "c").alias("component"), F.coalesce("head", "c").alias("head"),
        F.coalesce("dh", F.lit(0)).alias("dh")), "jaccard-known")

    # lists that still span several components
    mine = lists.join(known.select("c", "component"), "c")
    open_tokens = mine.groupBy("token").agg((F.min("component") < F.max("component")).alias("open")).where("open").select("token")
    cross = cross_pairs(stage(mine.join(open_tokens, "token"), "jaccard-open"), classes).join(first.select("a", "b"), ["a", "b"], "left_anti")
    ha, hb = known.select(F.col("c").alias("a"), F.col("head").alias("ha"), F.col("dh").alias("da")), \
        known.select(F.col("c").alias("b"), F.col("head").alias("hb"), F.col("dh").alias("db"))
    cross = stage(cross.join(ha, "a").join(hb, "b"), "jaccard-cross")
    if not cross.limit(1).count():
        return links
    size = classes.select("c", "n")
    top = (cross.select(F.greatest("ha", "hb").alias("a"), F.least("ha", "hb").alias("b")).distinct()
           .join(size.select(F.col("c").alias("a"), F.col("n").alias("na")), "a")
           .join(size.select(F.col("c").alias("b"), F.col("n").alias("nb")), "b"))
    answers = stage(differences(stage(top, "jaccard-heads"), docs, classes, width, broadcast_ids), "jaccard-answers")
    derived = stage(cross.withColumns({"p": F.greatest("ha", "hb"), "q": F.least("ha", "hb")}).join(
        answers.select(F.col("a").alias("p"), F.col("b").alias("q"), "d"), ["p", "q"])
        .withColumns({"most": F.col("d") + F.col("da") + F.col("db"), "least": F.col("d") - F.col("da") - F.col("db")}), "jaccard-derived")
    sure = derived.where("9 * most <= na + nb").select("a", "b")
    unsure = derived.where("9 * most > na + nb and 9 * least <= na + nb").select("a", "b", "na", "nb")
    links = links.union(sure)
    if unsure.limit(1).count():
        links = links.union(differences(unsure, docs, classes, width, broadcast_ids).where(LINK).select("a", "b"))
    return links


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
                       broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sets = stage(shingle_sets(rows, frequent_shingles(rows, width), width), "jaccard-sets")
    filled = sets.where("n > 0 and doc_id is not null")
    label = ["f1", "f2", "n"]
    classes = stage(filled.groupBy(*label).agg(F.min("doc_id").alias("rep"), *[F.first(x).alias(x) for x in ["level", *MAPS, "prefix"]])
                    .withColumn("c", F.monotonically_increasing_id()), "jaccard-classes")
    member = stage(filled.select("doc_id", *label).join(classes.select(*label, "c"), label).select("doc_id", "c").distinct(), "jaccard-member")
    # an id with several texts ties their classes together
    tied = member.groupBy("doc_id").agg(F.min("c").alias("b"), F.max("c").alias("most")).where("b < most").select("doc_id", "b")
    given = stage(member.join(tied, "doc_id").where("c <> b").select(F.col("c").alias("a"), "b").distinct(), "jaccard-tied")
    comp = components(join_classes(rows, classes, given, width, broadcast_ids))
    known = stage(classes.select("c", "rep").join(comp.withColumnRenamed("node", "c"), "c", "left")
                  .withColumn("component", F.coalesce("component", "c")), "jaccard-named")
    root = known.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_id = (member.join(known.join(root, "component").select("c", "component_id"), "c")
             .groupBy("doc_id").agg(F.min("component_id").alias("component_id")))
    return (sets.select("doc_id", F.col("n").alias("n_shingles")).join(by_id, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
