"""Prefix trie of conversations, built with adaptive radix trees.

A conversation becomes a byte string: the fixed-width big-endian ids of its
turns, one after the other. The id of a turn is the first 16 bytes of SHA-256
over (role, text), made by Spark where the text lies, so no text is shuffled.
The trie's nodes are the distinct turn sequences that begin some conversation.

1. ``numbered_turns``: turns in order, as (conv_id, pos, id, code points).
   A conversation of any length is ranked by range sort when it is too large
   for one window task.
2. ``rebuilt``: the caller's rule (see ``rebuild``) or the turns as they are.
3. ``segments``: a key row holds at most ``SEGMENT`` turns. A longer
   conversation is several rows; the trie of segment k hangs below the node
   that segment k-1 ends at, and is named by a digest of all before it.
4. ``trie_level``: equal keys are one row with a count first, so a hot group
   of copies is one key. Keys are range partitioned (distinct keys, so a
   first turn that a third of all conversations share is still split), and
   each row learns how many turns it shares with its predecessor.
5. Every block of sorted keys goes into an adaptive radix tree (nodes of 4,
   16, 48 and 256 children that grow, compressed paths, keys that end inside
   the tree). Only byte depths that are whole turns emit nodes. All figures
   of a node are sums or minima over its keys, so nodes that reach over a
   block's border are summed by their digest; the others are final at once.

Ids are compared by 128-bit digests. Memory of a task: one block of keys.

Defined results
* null conv_id: its rows belong to no conversation and are left out.
* null role or text: empty. Null turn: first.
* repeated rows: turns of their own. Turns with one number are ordered by role, then by digest.
* empty text: a turn of 0 code points; a turn like any other.
* very long texts: hashed and measured by Spark, never moved.
* extra columns: not read. Empty table: no conversation, no node, no row.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import prepared, stage
from quarry.operators.ranking import rank_within
from quarry.plans.execution import bounded_broadcast

ID = 16
SEGMENT = 4096
#: Keys, and bytes of keys, that one tree holds at a time.
BLOCK_KEYS = 1 << 15
BLOCK_BYTES = 16 << 20
#: Conversations whose ids are joined to one piece of text before hashing.
ID_BITS = 12
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
ROOT = b""


# ---------------------------------------------------------------- the tree

class Node4:
    """Up to ``room`` children in key order, found by binary search."""

    room = 4
    __slots__ = ("path", "end", "keys", "kids")

    def __init__(self, path: bytes):
        self.path, self.end, self.keys, self.kids = path, None, bytearray(), []

    def get(self, byte: int):
        at = bisect_left(self.keys, byte)
        return self.kids[at] if at < len(self.keys) and self.keys[at] == byte else None

    def put(self, byte: int, kid):
        """The node to go on with: this one, or its larger layout."""
        at = bisect_left(self.keys, byte)
        if at < len(self.keys) and self.keys[at] == byte:
            self.kids[at] = kid
        elif len(self.keys) == self.room:
            return grown(self).put(byte, kid)
        else:
            self.keys.insert(at, byte)
            self.kids.insert(at, kid)
        return self

    def children(self):
        return zip(self.keys, self.kids, strict=True)


class Node16(Node4):
    room = 16
    __slots__ = ()


class Node48:
    """One byte of index per key byte, 48 slots."""

    room = 48
    __slots__ = ("path", "end", "index", "kids")

    def __init__(self, path: bytes):
        self.path, self.end, self.index, self.kids = path, None, bytearray(256), []

    def get(self, byte: int):
        at = self.index[byte]
        return self.kids[at - 1] if at else None

    def put(self, byte: int, kid):
        at = self.index[byte]
        if at:
            self.kids[at - 1] = kid
        elif len(self.kids) == self.room:
            return grown(self).put(byte, kid)
        else:
            self.kids.append(kid)
            self.index[byte] = len(self.kids)
        return self

    def children(self):
        return ((b, self.kids[at - 1]) for b, at in enumerate(self.index) if at)


class Node256:
    """One slot per key byte."""

    room = 256
    __slots__ = ("path", "end", "kids")

    def __init__(self, path: bytes):
        self.path, self.end, self.kids = path, None, [None] * 256

    def get(self, byte: int):
        return self.kids[byte]

    def put(self, byte: int, kid):
        self.kids[byte] = kid
        return self

    def children(self):
        return ((b, kid) for b, kid in enumerate(self.kids) if kid is not None)


LARGER = {Node4: Node16, Node16: Node48, Node48: Node256}


def grown(node):
    out = LARGER[type(node)](node.path)
    out.end = node.end
    for byte, kid in node.children():
        out = out.put(byte, kid)
    return out


def shared(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # a[:lo] equal, a[:hi] not
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class AdaptiveRadixTree:
    """Byte strings -> values; walked in key order."""

    def __init__(self):
        self.root = None

    def insert(self, key: bytes, value) -> None:
        if self.root is None:
            self.root = Node4(key)
            self.root.end = value
            return
        node, at, parent, byte = self.root, 0, None, 0
        while True:
            same = shared(node.path, key[at:at + len(node.path)])
            if same < len(node.path):  # the compressed path splits here
                upper = Node4(node.path[:same])
                upper = upper.put(node.path[same], node)
                node.path = node.path[same + 1:]
                self._hang(parent, byte, upper)
                node = upper
            at += same
            if at == len(key):
                node.end = value
                return
            kid = node.get(key[at])
            if kid is None:
                leaf = Node4(key[at + 1:])
                leaf.end = value
                bigger = node.put(key[at], leaf)
                if bigger is not node:
                    self._hang(parent, byte, bigger)
                return
            parent, byte, node, at = node, key[at], kid, at + 1

    def _hang(self, parent, byte, node):
        if parent is None:
            self.root = node
        else:
            parent.put(byte, node)

    def nodes(self, width: int = ID):
        """The nodes at byte depths that are multiples of ``width``, as arrays
        (first key, key after the last, depth, index of the node above or -1),
        keys counted in key order. Iterative, so depth is no limit."""
        first, last, depth, above = [], [], [], []
        if self.root is None:
            return tuple(np.empty(0, np.int64) for _ in range(4))
        count = 0
        # (node, byte depth before its path, nearest emitted node above, bytes that lead in)
        todo = [(self.root, 0, -1, 0)]
        while todo:
            node, at, up, lead = todo.pop()
            if node is None:  # all keys below are counted: close the nodes at..lead
                for i in range(at, lead):
                    last[i] = count
                continue
            begin, stop = at - lead, at + len(node.path)
            opened = len(first)
            d = 0 if begin == 0 and lead == 0 else (begin // width + 1) * width
            while d <= stop:
                first.append(count)
                last.append(0)
                depth.append(d // width)
                above.append(up)
                up = len(first) - 1
                d += width
            if len(first) > opened:
                todo.append((None, opened, 0, len(first)))
            if node.end is not None:
                count += 1
            todo.extend((kid, stop + 1, up, 1) for _, kid in reversed(list(node.children())))
        return tuple(np.array(x, dtype=np.int64) for x in (first, last, depth, above))


# ------------------------------------------------------- rows of the trie

def turn_id(role: Column, text: Column) -> Column:
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * ID))


def numbered_turns(conversations: DataFrame, **limits) -> DataFrame:
    """(conv_id, pos, id, chars): turns counted from 1."""
    rows = (conversations.where("conv_id is not null")
            .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
                    F.coalesce("role", F.lit("")).alias("role"), turn_id(F.col("role"), F.col("text")).alias("id"),
                    F.length(F.coalesce("text", F.lit(""))).alias("chars")))
    order = [F.col("turn").asc_nulls_first(), "role", "id"]
    return rank_within(stage(rows, "trie-turns"), ["conv_id"], order, name="pos", **limits).select("conv_id", "pos", "id", "chars")


def rebuild(turns: DataFrame) -> DataFrame:
    """The rebuilt conversations: conversation c takes the first h turns of
    conversation c - c % 100 (h = crc32 of c's digits, modulo 6), then its own
    turns after its first h. Turnless ones have one row with pos 0."""
    h = (F.crc32(F.col("conv_id").cast("string")) % 6).cast("long")
    base = F.col("conv_id") - F.col("conv_id") % 100
    turns = stage(turns, "trie-numbered")
    # five turns at most of each base
    heads = (turns.where((F.col("conv_id") % 100 == 0) & (F.col("pos") <= 5)).groupBy(F.col("conv_id").alias("base"))
             .agg(F.array_sort(F.collect_list(F.struct("pos", "id", "chars"))).alias("head")))
    convs = (turns.where("pos = 1").select("conv_id", h.alias("h"), base.alias("base")).join(heads, "base", "left")
             .select("conv_id", "h", F.slice(F.coalesce("head", F.array().cast("array<struct<pos:bigint,id:binary,chars:int>>")), 1,
                                             F.col("h").cast("int")).alias("head")))
    convs = stage(convs, "trie-heads")
    own = (turns.join(convs.select("conv_id", "h", F.size("head").alias("had")), "conv_id").where("pos > h")
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("had")).alias("pos"), "id", "chars"))
    head = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.pos", "t.id", "t.chars")
    none = convs.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("id"), F.lit(0).alias("chars"))
    return own.unionByName(head).unionByName(none)


def segments(turns: DataFrame, size: int = SEGMENT) -> DataFrame:
    """(conv_id, seg, tree, key, lens, last, next): a conversation's keys by ``size`` turns.

    ``tree`` names what stands before the segment (empty for the first),
    ``next`` the tree below its end (null after the last segment).
    """
    seg = F.when(F.col("pos") > 0, F.floor((F.col("pos") - 1) / size)).otherwise(0).cast("long")
    parts = (turns.groupBy("conv_id", seg.alias("seg"))
             .agg(F.array_sort(F.collect_list(F.when(F.col("pos") > 0, F.struct("pos", "id", "chars")))).alias("t"))
             .select("conv_id", "seg", F.array_join(F.transform("t", lambda x: F.hex(x["id"])), "").alias("key"),
                     F.transform("t", lambda x: x["chars"]).alias("lens")))
    parts = stage(parts.withColumn("key", F.unhex("key")), "trie-segments")
    if not parts.where("seg > 0").limit(1).count():
        return parts.select("*", F.lit(ROOT).alias("tree"), F.lit(True).alias("last"), F.lit(None).cast("binary").alias("next"))
    mark = F.sha2(F.concat(F.encode(F.concat(F.col("seg").cast("string"), F.lit(":")), "UTF-8"), F.col("key")), 256)
    pieces = [F.conv(F.substring(mark, 1 + 12 * i, 12), 16, 10).cast("long") for i in range(3)]
    so_far = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, 0)
    name = F.unhex(F.substring(F.sha2(F.concat_ws(",", *[F.sum(p).over(so_far).cast("string") for p in pieces]), 256), 1, 2 * ID))
    by = Window.partitionBy("conv_id").orderBy("seg")
    out = parts.withColumn("below", name).withColumns({
        "tree": F.coalesce(F.lag("below").over(by), F.lit(ROOT)), "last": F.lead("seg").over(by).isNull()})
    return out.select("conv_id", "seg", "tree", "key", "lens", "last", F.when(~F.col("last"), F.col("below")).alias("next"))


def end_digests(ends: DataFrame) -> DataFrame:
    """(tree, key, ends_sha) of groups (tree, key, conv_id): SHA-256 of the ids
    in order, comma-joined. Ids are joined in pieces of bounded ranges of ids
    first; the pieces of a group are hashed one after the other in a stream."""
    named = ends.select(F.md5(F.concat(F.col("tree"), F.encode(F.lit("|"), "UTF-8"), F.col("key"))).alias("g"), "tree", "key", "conv_id")
    pieces = (named.groupBy("g", F.shiftright("conv_id", ID_BITS).alias("part"))
              .agg(F.first("tree").alias("tree"), F.first("key").alias("key"),
                   F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids")))

    def digest(batches):
        group, state, row = None, None, None
        for batch in batches:
            out = []
            for g, ids, tree, key in zip(*(batch.column(c).to_pylist() for c in ("g", "ids", "tree", "key")), strict=True):
                if g != group:
                    if group is not None:
                        out.append((*row, state.hexdigest()))
                    group, state, row = g, hashlib.sha256(ids.encode()), (tree, key)
                else:
                    state.update(b"," + ids.encode())
            if out:
                yield _digests(out)
        if group is not None:
            yield _digests([(*row, state.hexdigest())])

    ordered = pieces.repartition("g").sortWithinPartitions("g", "part").select("g", "ids", "tree", "key")
    return prepared(ordered).mapInArrow(digest, "tree binary, key binary, ends_sha string")


def _digests(rows):
    tree, key, sha = zip(*rows, strict=True)
    return pa.record_batch([pa.array(tree, pa.binary()), pa.array(key, pa.binary()), pa.array(sha)], names=["tree", "key", "ends_sha"])


def sorted_keys(keys: DataFrame) -> DataFrame:
    """The keys in order, each with ``lcp`` (turns shared with the key before;
    -1 where that lies in another tree) and ``leaf`` (no key goes on from it).
    Unknown across a partition's border at first, filled from the border rows."""
    n = max(1, int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = keys.repartitionByRange(n, "tree", "key").sortWithinPartitions("tree", "key")
    schema = keys.schema.simpleString()[7:-1].replace(":", " ") + ", lcp int, leaf boolean, part int, at long"

    def mark(batches):
        from pyspark import TaskContext

        part, held, before, at = TaskContext.get().partitionId(), None, None, 0

        def done(batch, after):
            nonlocal before, at
            trees, ids = batch.column("tree").to_pylist(), batch.column("key").to_pylist()
            lcp, leaf = [], []
            for i, (t, k) in enumerate(zip(trees, ids, strict=True)):
                follow = (trees[i + 1], ids[i + 1]) if i + 1 < len(ids) else after
                lcp.append(None if before is None else _turns_shared(before, (t, k)))
                leaf.append(None if follow is None else not _goes_on((t, k), follow))
                before = (t, k)
            extra = [pa.array(lcp, pa.int32()), pa.array(leaf, pa.bool_()), pa.array([part] * len(ids), pa.int32()),
                     pa.array(np.arange(at, at + len(ids)))]
            at += len(ids)
            return pa.record_batch([*batch.columns, *extra], names=[*batch.schema.names, "lcp", "leaf", "part", "at"])

        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield done(held, (batch.column("tree")[0].as_py(), batch.column("key")[0].as_py()))
            held = batch
        if held is not None:
            yield done(held, None)

    rows = stage(prepared(ordered).mapInArrow(mark, schema), "trie-sorted")
    # at most two rows a partition, in one small window
    by = Window.orderBy("tree", "key")
    edges = rows.where("lcp is null or leaf is null").select(
        "part", "tree", "key", "lcp", "leaf", F.lag(F.struct("tree", "key")).over(by).alias("b"), F.lead(F.struct("tree", "key")).over(by).alias("f"))

    def border(batches):
        for batch in batches:
            lcp, leaf = [], []
            for t, k, x, y, b, f in zip(*(batch.column(c).to_pylist() for c in ("tree", "key", "lcp", "leaf", "b", "f")), strict=True):
                lcp.append(None if x is not None else -1 if b is None else _turns_shared((b["tree"], b["key"]), (t, k)))
                leaf.append(None if y is not None else f is None or not _goes_on((t, k), (f["tree"], f["key"])))
            yield pa.record_batch([batch.column("part"), pa.array(lcp, pa.int32()), pa.array(leaf, pa.bool_())], names=["part", "lcp_", "leaf_"])

    # one row of a few bytes for each partition
    filled = prepared(edges).mapInArrow(border, "part int, lcp_ int, leaf_ boolean").groupBy("part").agg(
        F.max("lcp_").alias("lcp_"), F.max("leaf_").alias("leaf_"))
    return (rows.join(F.broadcast(stage(filled, "trie-borders")), "part")
            .select(*keys.columns, F.coalesce("lcp", "lcp_").alias("lcp"), F.coalesce("leaf", "leaf_").alias("leaf"), "part", "at"))


def _turns_shared(a, b) -> int:
    """Turns that two (tree, key) share; -1 if they lie in different trees."""
    return shared(a[1], b[1]) // ID if a[0] == b[0] else -1


def _goes_on(a, b) -> bool:
    return a[0] == b[0] and b[1].startswith(a[1])


LEVEL = ("whole boolean, node binary, up binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, next binary")


def _block_rows(block: list[tuple], base: int):
    """The nodes of one block of sorted keys: rows of LEVEL. ``block``: (tree,
    key, lens, n, low, lcp, leaf, ends_sha, next, kids below, leaves below,
    saved below), all of one tree."""
    trees, keys, lens, n, low, lcp, leaf, ends, nxt, kids, leaves, saved = zip(*block, strict=True)
    art = AdaptiveRadixTree()
    for i, k in enumerate(keys):
        art.insert(k, i)
    first, last, depth, above = art.nodes(ID)
    n, lcp = np.array(n, np.int64), np.array(lcp, np.int64)
    size = np.array([len(k) // ID for k in keys], np.int64)
    start = np.concatenate(([0], np.cumsum(size + 1)))[:-1]
    # code points before each turn of every key
    cum = np.concatenate([np.concatenate(([0], np.cumsum(x, dtype=np.int64))) if len(x) else np.zeros(1, np.int64) for x in lens])
    total = cum[start + size]
    total_of = lambda x: np.concatenate(([0], np.cumsum(x, dtype=np.int64)))
    shared_before = np.maximum(lcp, 0)
    # saved = sum of n x characters minus the characters of every distinct node once;
    # a key owns the nodes past what it shares with the key before it
    own = n * total - (total - cum[start + shared_before]) + np.array([x or 0 for x in saved], np.int64)
    below = np.array([x or 0 for x in leaves], np.int64)
    leaf_sum = total_of(np.where(below > 0, below, np.array(leaf, bool).astype(np.int64)))
    n_sum, own_sum = total_of(n), total_of(own)
    before = cum[start[first] + np.maximum(depth - 1, 0)]  # characters above the node's own turn
    is_new = lcp[first] < depth
    members = n_sum[last] - n_sum[first]
    gain = own_sum[last] - own_sum[first] - members * before + np.where(is_new, before - cum[start[first] + np.minimum(shared_before[first], size[first])], 0)
    n_kids = np.bincount(above[(above >= 0) & is_new], minlength=len(first)).astype(np.int64)
    least = np.array(low, np.int64)
    smallest = np.array([least[a:b].min() if b - a < 64 else 0 for a, b in zip(first, last, strict=True)], np.int64)
    wide = np.flatnonzero(last - first >= 64)
    if len(wide):
        table = _range_minima(least)
        for i in wide.tolist():
            k = int(last[i] - first[i]).bit_length() - 1
            smallest[i] = min(table[k][first[i]], table[k][last[i] - (1 << k)])
    ended = size[first] == depth  # the key that ends at a node is its first
    for i in np.flatnonzero(ended).tolist():
        n_kids[i] += kids[first[i]] or 0
    # nodes whose keys may go on in another block, and the tree's own root
    open_ = ((first == 0) & ~is_new) | (last == len(keys)) | (depth == 0)
    tree = trees[0]
    names: list[bytes | None] = [None] * len(first)
    paths = {}
    for i in np.flatnonzero(open_).tolist():
        d = int(depth[i])
        if d == 0:
            names[i] = tree
            continue
        state = paths[int(above[i])].copy() if int(above[i]) in paths else hashlib.sha256(tree + b"/")
        state.update(keys[first[i]][(d - 1) * ID:d * ID])
        paths[i] = state
        names[i] = state.digest()[:ID]
    up_open = np.where(above >= 0, open_[np.maximum(above, 0)], False)
    out = {
        "whole": ~open_, "node": names, "up": [names[a] if o else None for a, o in zip(above.tolist(), up_open.tolist(), strict=True)],
        "conv_id": smallest, "depth": depth + base,
        "parent_conv_id": [None if a < 0 or o else int(smallest[a]) for a, o in zip(above.tolist(), up_open.tolist(), strict=True)],
        "n_convs": members, "n_children": n_kids, "n_leaves": leaf_sum[last] - leaf_sum[first], "saved_tokens": gain,
        "ends_sha256": [ends[f] if e else None for f, e in zip(first.tolist(), ended.tolist(), strict=True)],
        "next": [nxt[f] if e else None for f, e in zip(first.tolist(), ended.tolist(), strict=True)]}
    kinds = {"whole": pa.bool_(), "node": pa.binary(), "up": pa.binary(), "ends_sha256": pa.string(), "next": pa.binary()}
    return pa.record_batch([pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()], names=list(out))


def _range_minima(x: np.ndarray) -> list[np.ndarray]:
    table = [x]
    while 2 << (len(table) - 1) <= len(x):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    return table


def trie_level(rows: DataFrame, below: DataFrame | None, base: int) -> tuple[DataFrame, DataFrame]:
    """(nodes, roots) of the tries of one segment level. ``rows``: segments of
    that level; ``below``: roots of the next level, or None."""
    groups = rows.groupBy("tree", "key").agg(
        F.first("lens").alias("lens"), F.count("*").alias("n"), F.min("conv_id").alias("low"), F.max("next").alias("next"),
        F.count_if("last").alias("n_ends"), F.min(F.when(F.col("last"), F.col("conv_id"))).alias("end"))
    groups = stage(groups, "trie-keys")
    many = rows.where("last").join(groups.where("n_ends > 1").select("tree", "key"), ["tree", "key"], "left_semi")
    keys = groups.join(end_digests(many.select("tree", "key", "conv_id")), ["tree", "key"], "left").withColumn(
        "ends_sha", F.when(F.col("n_ends") == 1, F.sha2(F.col("end").cast("string"), 256)).otherwise(F.col("ends_sha"))).drop("n_ends", "end")
    if below is None:
        keys = keys.withColumns({c: F.lit(None).cast("long") for c in ("kids", "leaves", "saved")})
    else:
        keys = keys.join(below.select(F.col("node").alias("next"), F.col("n_children").alias("kids"), F.col("n_leaves").alias("leaves"),
                                      F.col("saved_tokens").alias("saved")), "next", "left")
    columns = ["tree", "key", "lens", "n", "low", "lcp", "leaf", "ends_sha", "next", "kids", "leaves", "saved"]
    ordered = sorted_keys(stage(keys.select(*[c for c in columns if c not in ("lcp", "leaf")]), "trie-keys"))

    def build(batches):
        block, held, expected = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in [*columns, "part", "at"]), strict=True):
                here = (row[0], *row[-2:])
                # a block is an unbroken run of one tree's sorted keys
                if block and (here != expected or len(block) >= BLOCK_KEYS or held >= BLOCK_BYTES):
                    yield _block_rows(block, base)
                    block, held = [], 0
                block.append(row[:-2])
                held += len(row[1]) * 2
                expected = (row[0], row[-2], row[-1] + 1)
        if block:
            yield _block_rows(block, base)

    out = stage(prepared(ordered).select(*columns, "part", "at").mapInArrow(build, LEVEL), "trie-nodes")
    open_ = out.where("not whole").groupBy("node").agg(
        F.max("up").alias("up"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        F.max("parent_conv_id").alias("parent_conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends_sha256").alias("ends_sha256"), F.max("next").alias("next"))
    open_ = stage(open_, "trie-open")
    roots = open_.where(F.col("depth") == base)
    nodes = out.where("whole").drop("whole").unionByName(open_ if base == 0 else open_.where(F.col("depth") > base))
    return nodes, roots


def prefix_trie(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Nodes of the trie over ``turns`` (conv_id, pos, id, chars); pos 0 marks a
    conversation that may have no turn."""
    rows = stage(segments(turns, segment), "trie-rows")
    deepest = rows.agg(F.max("seg")).collect()[0][0] or 0
    below, levels = None, []
    for seg in range(deepest, -1, -1):
        nodes, below = trie_level(rows.where(F.col("seg") == seg), below, seg * segment)
        levels.append(nodes)
    nodes = levels[0]
    for more in levels[1:]:
        nodes = nodes.unionByName(more)
    # names that other nodes know their parent by
    names = (nodes.where("node is not null").select(F.col("node").alias("up"), F.col("conv_id").alias("p"))
             .union(nodes.where("next is not null").select("next", "conv_id")).distinct())
    names = bounded_broadcast(stage(names, "trie-names"), 1_000_000)
    known = nodes.where("up is null").withColumn("p", F.col("parent_conv_id"))
    return (nodes.where("up is not null").join(names, "up").unionByName(known)
            .select("conv_id", "depth", F.col("p").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                    "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256")))
