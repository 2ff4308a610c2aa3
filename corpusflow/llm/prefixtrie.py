"""Conversation prefix trie by ternary search trees.

Turns become ids of a dictionary of distinct (role, text) pairs, conversations sequences of ids, and
equal sequences one weighted row. The sorted distinct sequences are cut into ranges; every range shard
builds a ternary search tree over its own by median insertion, so that its sibling trees are balanced,
and one iterative walk from the last node to the first adds up members, leaves and savings. Only nodes
on the path of a shard's first or last sequence can also be in another shard: these are emitted as
parts and merged by their path, the rest is final. A conversation of more than ``segment_turns`` turns
is cut into segments; a segment's tree hangs below the node at which the segment before it ends, so
that no row or group is longer than that, however long a conversation is.

What meets in one task: a shard of about ``shard_turns`` ids, and, of the nodes that shards share, at
most two paths a shard of ``segment_turns`` nodes.

Defined results: rows without a conversation id are ignored; a null role or text is empty; turns are
ordered by number, null first, and turns of one number by the digest of role and text; repeated rows
are turns of their own; conversations without any turn can be given and are members of the root; no
conversation at all gives no nodes; other columns are ignored. Texts enter a hash whole, whatever
their length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import prepare, written

#: Turn numbers of one window partition: a longer conversation is numbered in several.
NUMBERS = 1024
INNER, SHARED, TOP = 0, 1, 2
PART = pa.schema([("kind", pa.int32()), ("start", pa.string()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()),
                  ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()), ("chars", pa.int64()),
                  ("end_key", pa.string()), ("path", pa.binary()), ("up", pa.binary())])
PART_DDL = ("kind int, start string, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
            "saved long, chars long, end_key string, path binary, up binary")
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "end_key"]


def encode(turns: DataFrame) -> DataFrame:
    """Dictionary-encoded turns: conv_id, pos (from 0), token (one per distinct role and text), chars.

    Texts are read and hashed once; a conversation is numbered in buckets of turn numbers, so one that
    holds a third of all turns is dealt over many tasks.
    """
    prepare(turns.sparkSession)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    number = F.col("turn").cast("long")
    narrow = written(turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), number.alias("turn"),
        F.coalesce(F.floor(number / NUMBERS), F.lit(-(1 << 60))).cast("long").alias("bucket"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.length(text).cast("long").alias("chars")), "trie-turns")
    dictionary = written(narrow.select("digest").distinct().withColumn("token", F.monotonically_increasing_id()), "trie-dictionary")
    sizes = narrow.groupBy("conv_id", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("conv_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("conv_id", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("conv_id", "bucket").orderBy(F.asc_nulls_first("turn"), "digest")
    numbered = narrow.join(dictionary, "digest").withColumn("rank", F.row_number().over(inside)).join(offsets, ["conv_id", "bucket"])
    return written(numbered.select("conv_id", (F.col("offset") + F.col("rank") - 1).alias("pos"), "token", "chars"), "trie-encoded")


class TernaryTree:
    """Sequences of ids under one or more tops. ``lower`` and ``higher`` are the sibling tree of an id,
    ``equal`` the root of its children's; ``up`` is the node before it in a sequence."""

    def __init__(self):
        self.token, self.lower, self.higher, self.equal, self.up = [], [], [], [], []
        self.depth, self.members, self.first, self.chars = [], [], [], []
        self.ends: dict[int, int] = {}

    def node(self, token, up: int, depth: int, chars: int) -> int:
        for column, value in ((self.token, token), (self.lower, -1), (self.higher, -1), (self.equal, -1), (self.up, up),
                              (self.depth, depth), (self.members, 0), (self.first, None), (self.chars, chars)):
            column.append(value)
        return len(self.token) - 1

    def insert(self, top: int, ids, chars, members: int, first: int, row: int) -> list[int]:
        """Add a sequence; the nodes of its path, top included."""
        token, lower, higher, equal = self.token, self.lower, self.higher, self.equal
        path = [top]
        for depth, (wanted, length) in enumerate(zip(ids, chars), 1):
            at, came, link = equal[path[-1]], path[-1], equal
            while at >= 0 and token[at] != wanted:
                came, link = at, lower if wanted < token[at] else higher
                at = link[at]
            if at < 0:
                at = self.node(wanted, path[-1], depth, length)
                link[came] = at
            path.append(at)
        for at in path:
            self.members[at] += members
            self.first[at] = first if self.first[at] is None else min(self.first[at], first)
        self.ends[path[-1]] = row
        return path


def medians(n: int) -> Iterator[int]:
    """0 .. n - 1, the middle of every range before its halves."""
    ranges = [(0, n)]
    while ranges:
        a, b = ranges.pop()
        if a < b:
            mid = (a + b) // 2
            yield mid
            ranges += [(mid + 1, b), (a, mid)]


def shard_nodes(rows: pd.DataFrame, base: int) -> list[tuple]:
    """Parts and final nodes of the sorted sequences of one shard, whose tops lie at depth ``base``."""
    tree, last = TernaryTree(), len(rows) - 1
    start_of, ids, chars, key_of = (rows[c].tolist() for c in ("start", "ids", "chars", "key"))
    members, first = rows["members"].tolist(), rows["first"].tolist()
    top = {start: tree.node(None, -1, 0, 0) for start in dict.fromkeys(start_of)}
    path_of = {}
    for at in medians(len(rows)):
        path = tree.insert(top[start_of[at]], ids[at], chars[at], members[at], first[at], at)
        if at in (0, last):
            path_of[at] = path
    n = len(tree.token)
    # the paths of the first and last sequence: (start, digest of the path) of nodes that other shards may hold
    name: list[tuple | None] = [None] * n
    for at, path in path_of.items():
        state = hashlib.sha256(start_of[at].encode())
        for node in path:
            if tree.up[node] >= 0:
                state.update(int(tree.token[node]).to_bytes(8, "little", signed=True))
            name[node] = (start_of[at], state.digest())
    start_at = {node: start for start, node in top.items()}
    if base:  # a top ends a segment before, which knows its first member
        for start, conv in zip(start_of, rows["start_conv"].tolist()):
            tree.first[top[start]] = int(conv)
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    below = [rows[c].tolist() for c in ("below_children", "below_leaves", "below_saved")]
    for node, row in tree.ends.items():
        children[node], leaves[node], saved[node] = (int(c[row]) for c in below)
    out = []
    for node in range(n - 1, -1, -1):  # a child is younger than its parent
        up, shared = tree.up[node], name[node]
        if not shared:
            leaves[node] = leaves[node] or 1
            saved[node] += (tree.members[node] - 1) * tree.chars[node]
            if up >= 0:
                children[up], leaves[up], saved[up] = children[up] + 1, leaves[up] + leaves[node], saved[up] + saved[node]
        under = name[up] if up >= 0 else None
        out.append((SHARED if shared else TOP if up < 0 else INNER, shared[0] if shared else start_at.get(node),
                    base + tree.depth[node], tree.first[node], tree.first[up] if up >= 0 and not under else None,
                    tree.members[node], children[node], leaves[node], saved[node], tree.chars[node],
                    key_of[tree.ends[node]] if node in tree.ends and (up >= 0 or not base) else None,
                    shared[1] if shared else None, under[1] if under else None))
    return out


def merge_shared(parts: pd.DataFrame, base: int) -> pd.DataFrame:
    """Final nodes of the paths that shards share under one top, from their summed parts: from the
    deepest up, each adds itself to its parent."""
    parts = parts.sort_values("depth", ascending=False, kind="stable")
    at = {path: k for k, path in enumerate(parts["path"])}
    ups = [at.get(up, -1) for up in parts["up"]]
    depth, members, first, chars = (parts[c].tolist() for c in ("depth", "n_convs", "conv_id", "chars"))
    children, leaves, saved = (parts[c].tolist() for c in ("n_children", "n_leaves", "saved"))
    for k, up in enumerate(ups):
        leaves[k] = leaves[k] or 1
        saved[k] += (members[k] - 1) * chars[k]
        if up >= 0:
            children[up], leaves[up], saved[up] = children[up] + 1, leaves[up] + leaves[k], saved[up] + saved[k]
    return pd.DataFrame({
        "kind": [TOP if base and up < 0 else INNER for up in ups], "start": parts["start"].to_numpy(), "depth": depth, "conv_id": first,
        "parent_conv_id": pd.array([first[up] if up >= 0 else None for up in ups], dtype="Int64"), "n_convs": members, "n_children": children,
        "n_leaves": leaves, "saved": saved, "chars": chars, "end_key": parts["end_key"].to_numpy(), "path": parts["path"].to_numpy(), "up": None})


def segment_trie(found: DataFrame, base: int, shard_turns: int) -> tuple[DataFrame, DataFrame]:
    """Nodes of the sequences ``found`` (start, start_conv, key, ids, chars, members, first, below_*),
    and what each top has below it."""
    total = found.agg(F.sum(F.size("ids") + 1)).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b.to_pandas() for b in batches if b.num_rows]
        if rows:
            nodes = shard_nodes(pd.concat(rows, ignore_index=True), base)
            for at in range(0, len(nodes), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*nodes[at:at + 4096]), PART)], schema=PART)

    ranged = found.repartitionByRange(max(1, -(-total // shard_turns)), "start", "ids").sortWithinPartitions("start", "ids")
    parts = written(ranged.mapInArrow(run, PART_DDL), "trie-parts")
    shared = parts.where(F.col("kind") == SHARED).groupBy("start", "path").agg(
        F.lit(SHARED).alias("kind"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.lit(None).cast("long").alias("parent_conv_id"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")),
        F.max("chars").alias("chars"), F.max("end_key").alias("end_key"), F.max("up").alias("up"))
    merged = written(shared.groupBy("start").applyInPandas(lambda pdf: merge_shared(pdf, base), PART_DDL), "trie-shared")
    inner = parts.where(F.col("kind") == INNER)
    parent = merged.select(F.col("path").alias("up"), F.col("conv_id").alias("of_shared"))
    under = inner.where("up is not null").join(parent, "up").withColumn("parent_conv_id", F.col("of_shared")).drop("of_shared")
    nodes = (inner.where("up is null").unionByName(under).unionByName(merged.where(F.col("kind") == INNER)))
    tops = (parts.where(F.col("kind") == TOP).unionByName(merged.where(F.col("kind") == TOP))
            .select("start", F.col("n_children").alias("below_children"), F.col("n_leaves").alias("below_leaves"), F.col("saved").alias("below_saved")))
    return nodes.withColumnRenamed("saved", "saved_tokens").select(*NODE), tops


def build(encoded: DataFrame, conversations: DataFrame, segment_turns: int = 512, shard_turns: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """The trie over sequences of turns: nodes and ends.

    ``encoded`` has conv_id, pos (0, 1, ... within a conversation), token, chars; ``conversations`` the
    ids of all members, with or without turns. Nodes: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, end_key (null if no member ends there). Ends: conv_id
    and end_key of every member.
    """
    layer = F.floor(F.col("pos") / segment_turns).cast("int")
    gathered = encoded.groupBy("conv_id", layer.alias("layer")).agg(F.array_sort(F.collect_list(F.struct("pos", "token", "chars"))).alias("turns"))
    segments = written(gathered.select("conv_id", "layer", F.col("turns.token").alias("ids"), F.col("turns.chars").alias("chars")), "trie-segments")
    last = segments.agg(F.max("layer")).first()[0] or 0
    none = F.array().cast("array<long>")
    turnless = conversations.select("conv_id").distinct().join(segments.where("layer = 0").select("conv_id"), "conv_id", "left_anti")
    at = segments.where("layer = 0").unionByName(turnless.select("conv_id", F.lit(0).alias("layer"), none.alias("ids"), none.alias("chars")))
    at = at.withColumns({"start": F.lit(""), "start_conv": F.lit(None).cast("long")})
    layers, ends = [], []
    for k in range(last + 1):  # forward: which node a segment hangs under; more than once for very long conversations only
        path = F.concat("start", F.lit("|"), F.array_join(F.transform("ids", lambda t: t.cast("string")), ","))
        keyed = written(at.withColumn("key", F.sha2(path.cast("binary"), 256)), "trie-keyed")
        same = keyed.groupBy("start", "start_conv", "key", "ids", "chars").agg(F.count(F.lit(1)).alias("members"), F.min("conv_id").alias("first"))
        layers.append(written(same, "trie-sequences"))
        going = segments.where(F.col("layer") == k + 1)
        ends.append(keyed.join(going.select("conv_id"), "conv_id", "left_anti").select("conv_id", F.col("key").alias("end_key")))
        step = (keyed.where(F.size("ids") == segment_turns).select("conv_id", F.col("key").alias("start"))
                .join(layers[-1].select(F.col("key").alias("start"), F.col("first").alias("start_conv")), "start"))
        at = going.join(step, "conv_id")
    nodes, tops = [], None
    for k in range(last, -1, -1):
        found = layers[k]
        if tops is None:
            found = found.withColumns({c: F.lit(0).cast("long") for c in ("below_children", "below_leaves", "below_saved")})
        else:
            found = (found.join(tops.withColumnRenamed("start", "key"), "key", "left")
                     .fillna(0, ["below_children", "below_leaves", "below_saved"]))
        here, tops = segment_trie(found, k * segment_turns, shard_turns)
        nodes.append(here)
    every, over = nodes[0], ends[0]
    for more, further in zip(nodes[1:], ends[1:]):
        every, over = every.unionByName(more), over.unionByName(further)
    # a member that goes on below is no member that ends: keys at which none ends are dropped
    ending = over.select("end_key").distinct().withColumn("is_end", F.lit(True))
    with_end = every.where("end_key is not null").join(ending, "end_key", "left").withColumn(
        "end_key", F.when(F.col("is_end"), F.col("end_key"))).drop("is_end")
    return every.where("end_key is null").unionByName(with_end), over


def digest_of_ends(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined ids that end at each key. A digest needs its ids in one
    order, so those of a key are streamed through one task, sorted and never gathered."""
    schema = pa.schema([("end_key", pa.string()), ("ends_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column(0)
            changed = np.flatnonzero(np.array(names.dictionary_encode().indices[1:]) != np.array(names.dictionary_encode().indices[:-1])) + 1
            cuts = [0, *changed.tolist(), batch.num_rows]
            ids = batch.column(1).to_pylist()
            for a, b in zip(cuts[:-1], cuts[1:]):
                name, text = names[a].as_py(), ",".join(map(str, ids[a:b])).encode()
                if name == key:
                    state.update(b"," + text)
                    continue
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = name, hashlib.sha256(text)
            if len(done) >= 1024:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done)], schema=schema)
                done = []
        if key is not None:
            done.append((key, state.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done)], schema=schema)

    return (ends.select("end_key", "conv_id").repartition("end_key").sortWithinPartitions("end_key", "conv_id")
            .mapInArrow(run, "end_key string, ends_sha256 string"))
