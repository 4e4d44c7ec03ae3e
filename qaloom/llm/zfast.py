"""Prefix trie of conversations as z-fast tries.

A conversation is the path of its turns. A compacted node stands for an edge: the depths (low, depth] of one path.
It is hashed under its handle, the prefix whose length is the two-fattest number of that range, so the node at which a
path leaves the trie is found by a binary search over lengths with one look-up a step. Every prefix has a
128-bit digest chained from the digests of its turns; a path is the digests of its prefixes, end to end.

Paths are sorted over the whole cluster, which makes every subtree a run of paths, and each range of them is one trie,
filled batch by batch. Edges are then expanded to one row a turn; the few nodes that lie in several ranges are
added up by digest, and sums over subtrees are differences of running sums in preorder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaloom.llm.common import batches
from qaloom.session import checked_broadcast, global_index, materialize

DIGEST = 16
ROOT = bytes(DIGEST)
# Turns of another conversation that a rebuilt one may begin with, at most.
MOST_SHARED = 8
# A trie with so many turns is handed on and a new one begun; equal nodes are added up afterwards.
TRIE_TURNS = 1 << 18
PIECE_CHARS = 1 << 20


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] with the most trailing zero bits."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


@dataclass(slots=True)
class Node:
    """A compacted node: the turns at depths (low, depth] of ``path``; totals are of its whole subtree once summed."""

    path: bytes
    sizes: np.ndarray
    low: int
    depth: int
    parent: Node | None
    children: dict[bytes, Node] = field(default_factory=dict)
    n_convs: int = 0
    conv_id: int | None = None
    first: int | None = None
    last: int | None = None

    def digest(self, d: int) -> bytes:
        return self.path[(d - 1) * DIGEST: d * DIGEST] if d else ROOT


class ZFastTrie:
    """Compacted trie over paths; ``handles`` maps the digest of each node's handle to the node."""

    def __init__(self) -> None:
        self.root = Node(b"", np.zeros(0, np.int64), 0, 0, None)
        self.handles: dict[bytes, Node] = {}
        self.turns = 0

    def _enter(self, node: Node) -> None:
        self.handles[node.digest(two_fattest(node.low, node.depth))] = node

    def exit_node(self, path: bytes, below: Node | None = None) -> Node:
        """The node whose edge the path leaves, or ends on. ``below`` is a node known to lie on the path."""
        found = below or self.root
        low, high = found.depth, len(path) // DIGEST
        while low < high:
            f = two_fattest(low, high)
            node = self.handles.get(path[(f - 1) * DIGEST: f * DIGEST])
            if node is None:
                high = f - 1
            else:
                found, low = node, node.depth
        # A child whose handle lies behind the place where the path leaves it.
        end = found.depth * DIGEST
        if end < len(path) and found.digest(found.depth) == (path[end - DIGEST: end] if end else ROOT):
            return found.children.get(path[end: end + DIGEST], found)
        return found

    def insert_batch(self, rows: list[tuple[bytes, np.ndarray, int, int, int]]) -> None:
        """Paths with (sizes of turns, conversations, smallest id, place in the order of paths).

        All are located in the trie as it stands; those with one exit node are then inserted together,
        each later one searched from the node above that exit only.
        """
        leaving: dict[int, tuple[Node, list]] = {}
        for row in rows:
            node = self.exit_node(row[0])
            leaving.setdefault(id(node), (node, []))[1].append(row)
        for node, group in leaving.values():
            above = node.parent or node
            for k, row in enumerate(group):
                self._insert(self.exit_node(row[0], above) if k else node, *row)

    def _insert(self, node: Node, path: bytes, sizes: np.ndarray, n: int, conv_id: int, place: int) -> None:
        depth = len(path) // DIGEST
        # Digests are of whole prefixes: they agree up to the place of parting and nowhere after it.
        low, high = node.low, min(node.depth, depth)
        while low < high:
            middle = (low + high + 1) // 2
            if path[(middle - 1) * DIGEST: middle * DIGEST] == node.digest(middle):
                low = middle
            else:
                high = middle - 1
        if low < node.depth:
            node = self._split(node, low)
        if low < depth:
            leaf = Node(path, sizes, low, depth, node)
            node.children[leaf.digest(low + 1)] = leaf
            self._enter(leaf)
            self.turns += depth - low
            node = leaf
        node.n_convs += n
        node.conv_id = conv_id if node.conv_id is None else min(node.conv_id, conv_id)
        node.first = place if node.first is None else min(node.first, place)
        node.last = place if node.last is None else max(node.last, place)

    def _split(self, node: Node, depth: int) -> Node:
        """A node that ends at ``depth`` of the edge of ``node``, which keeps the rest and takes a new handle."""
        del self.handles[node.digest(two_fattest(node.low, node.depth))]
        upper = Node(node.path, node.sizes, node.low, depth, node.parent)
        node.parent.children[node.digest(node.low + 1)] = upper
        upper.children[node.digest(depth + 1)] = node
        node.low, node.parent = depth, upper
        self._enter(upper)
        self._enter(node)
        return upper

    def expanded(self) -> Iterator[tuple]:
        """A row for each turn of each edge, and one for the root.

        (digest, depth, parent's digest, bytes, conversations, smallest id, first and last place, parent's
        smallest id, children), all as far as this trie knows.
        """
        order, stack = [], [self.root]
        while stack:
            node = stack.pop()
            order.append(node)
            stack.extend(node.children.values())
        for node in reversed(order):
            for child in node.children.values():
                node.n_convs += child.n_convs
                for name, least in (("conv_id", min), ("first", min), ("last", max)):
                    ours, theirs = getattr(node, name), getattr(child, name)
                    setattr(node, name, theirs if ours is None else least(ours, theirs))
        for node in order:
            own = (node.n_convs, node.conv_id, node.first, node.last)
            if node.parent is None:
                yield (ROOT, 0, None, 0, *own, None, len(node.children))
                continue
            for d in range(node.low + 1, node.depth + 1):
                above = node.parent.conv_id if d == node.low + 1 else node.conv_id
                yield (node.digest(d), d, node.digest(d - 1), int(node.sizes[d - 1]), *own, above, len(node.children) if d == node.depth else 1)


# --- conversations ----------------------------------------------------------------------------

def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes over: crc32 of the decimal id, modulo 9."""
    return (F.crc32(conv_id.cast("string")) % (MOST_SHARED + 1)).cast("int")


def turn_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, size) of (conv_id, turn, role, text): all that later steps move of a turn.

    Null role or text is empty. Rows without conv_id are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)))
    return turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), digest.alias("digest"), F.octet_length(text).cast("long").alias("size"))


def rebuilt_turns(hashed: DataFrame) -> DataFrame:
    """(conv_id, place, digest, size) of every rebuilt conversation and one row at place -1 for each, so that none is missing.

    Conversation c begins with the first h turns of conversation c - c % 5 and goes on with its own from the h-th.
    Turns stand in the order of turn (null first), then role, then digest.
    """
    # A distributed sort and per-range counts, so one conversation with a third of all turns is many ranges.
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest"]
    in_order = materialize(global_index(materialize(hashed, "turn-digests"), *order, name="at"), "sorted-turns")
    convs = materialize(in_order.groupBy("conv_id").agg(F.min("at").alias("first"), F.count("*").alias("n")).withColumn(
        "h", shared_turns(F.col("conv_id"))), "conversations")
    # Lent turns: at most eight of a conversation, to at most five conversations.
    lenders = convs.select(F.col("conv_id").alias("lender"), F.col("first").alias("lent_first"), F.col("n").alias("lent"))
    known = convs.withColumn("lender", F.expr("conv_id - conv_id % 5")).join(lenders, "lender", "left").select(
        "conv_id", "lender", "first", "h", F.least("h", F.coalesce("lent", F.lit(0))).alias("taken"))
    known = materialize(known, "borrowers")
    heads = in_order.join(lenders.withColumnRenamed("lender", "conv_id"), "conv_id").select(
        F.col("conv_id").alias("lender"), (F.col("at") - F.col("lent_first")).alias("place"), "digest", "size").where(F.col("place") < MOST_SHARED)
    taken = known.select("conv_id", "lender", "taken").join(heads, "lender").where("place < taken").select("conv_id", "place", "digest", "size")
    own = in_order.join(known, "conv_id").where("at - first >= h").select(
        "conv_id", F.expr("at - first - h + taken").alias("place"), "digest", "size")
    every = known.select("conv_id", F.lit(-1).cast("long").alias("place"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("size"))
    return own.unionByName(taken).unionByName(every)


def conversation_paths(turns: DataFrame) -> DataFrame:
    """(conv_id, path, sizes): digests of all prefixes and bytes of all texts of each rebuilt conversation.

    Turns are hashed where they lie; only digests travel. Rows are sorted by (conv_id, place) over the whole cluster; each
    range hands on what it holds of a conversation as one row, and these few rows are chained. A path is one cell: 16 bytes a turn.
    """
    ranged = materialize(rebuilt_turns(turn_digests(turns)), "rebuilt").repartitionByRange("conv_id", "place").sortWithinPartitions(
        "conv_id", "place")
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("turns", pa.binary()), ("sizes", pa.binary())])

    def runs(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        key, begin, held, sizes = None, 0, [], []
        for part in parts:
            for conv, place, digest, size in zip(*(c.to_pylist() for c in part.columns)):
                if conv != key:
                    if key is not None:
                        yield key, begin, b"".join(held), np.array(sizes, "<i8").tobytes()
                    key, begin, held, sizes = conv, place, [], []
                if place >= 0:
                    held.append(digest)
                    sizes.append(size)
        if key is not None:
            yield key, begin, b"".join(held), np.array(sizes, "<i8").tobytes()

    ranges = ranged.mapInArrow(lambda parts: batches(runs(parts), schema, 256), "conv_id long, place long, turns binary, sizes binary")
    joined = ranges.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "turns", "sizes"))).alias("runs"))
    out = pa.schema([("conv_id", pa.int64()), ("path", pa.binary()), ("sizes", pa.binary())])

    def chain(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for part in parts:
            for conv, found in zip(part.column(0).to_pylist(), part.column(1)):
                found = found.as_py()
                steps, last = [], ROOT
                for run in found:
                    for at in range(0, len(run["turns"]), DIGEST):
                        last = hashlib.md5(last + run["turns"][at: at + DIGEST]).digest()
                        steps.append(last)
                yield conv, b"".join(steps), b"".join(run["sizes"] for run in found)

    return joined.mapInArrow(lambda parts: batches(chain(parts), out, 256), "conv_id long, path binary, sizes binary")


def ends_digests(paths: DataFrame) -> DataFrame:
    """(node, ends_sha256): digest of the ids, ascending and comma-joined, of all conversations with exactly that path.

    Ids are sorted over the whole cluster and joined to pieces where they lie; the digest then reads the few pieces
    of a node in order and holds its state only.
    """
    node = F.when(F.octet_length("path") == 0, F.lit(ROOT)).otherwise(F.substring("path", F.octet_length("path") - DIGEST + 1, DIGEST))
    ids = materialize(paths.select(node.alias("node"), "conv_id"), "ends")
    ranged = ids.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    schema = pa.schema([("node", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])

    def join(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        node, first, held, size = None, 0, [], 0
        for part in parts:
            for key, conv in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if held and (key != node or size > PIECE_CHARS):
                    yield node, first, ",".join(held)
                    held, size = [], 0
                if not held:
                    node, first = key, conv
                held.append(str(conv))
                size += len(held[-1]) + 1
        if held:
            yield node, first, ",".join(held)

    pieces = ranged.mapInArrow(lambda parts: batches(join(parts), schema, 16), "node binary, first long, ids string")
    together = pieces.repartition("node").sortWithinPartitions("node", "first")
    out = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])

    def digest(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        node, state = None, None
        for part in parts:
            for key, ids in zip(part.column(0).to_pylist(), part.column(2)):
                if key != node:
                    if state:
                        yield node, state.hexdigest()
                    node, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.as_py().encode())
        if state:
            yield node, state.hexdigest()

    return together.mapInArrow(lambda parts: batches(digest(parts), out), "node binary, ends_sha256 string")


TRIE_SQL = ("node binary, depth long, parent binary, size long, n_convs long, conv_id long, first long, last long, "
            "parent_conv_id long, n_children long")


def trie_rows(sequences: DataFrame) -> DataFrame:
    """Rows of the expanded tries over (path, sizes, n_convs, conv_id, at): one trie a partition, or a few where it is large."""
    schema = pa.schema([(name, {"binary": pa.binary(), "long": pa.int64()}[kind]) for name, kind in (c.split() for c in TRIE_SQL.split(", "))])

    def grow(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        trie = None
        for part in parts:
            rows = [(path, np.frombuffer(sizes, "<i8"), n, conv, at) for path, sizes, n, conv, at in zip(*(c.to_pylist() for c in part.columns))]
            for begin in range(0, len(rows), 1000):
                trie = trie or ZFastTrie()
                trie.insert_batch(rows[begin: begin + 1000])
                if trie.turns >= TRIE_TURNS:
                    yield from trie.expanded()
                    trie = None
        if trie:
            yield from trie.expanded()

    return sequences.select("path", "sizes", "n_convs", "conv_id", "at").mapInArrow(lambda parts: batches(grow(parts), schema), TRIE_SQL)


def running_sums(rows: DataFrame, order: list[str], weights: list[str]) -> DataFrame:
    """``rows`` with ``<weight>_up_to``: the sum of each weight over all rows up to and with this one in ``order``."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    added = [f"{w}_up_to" for w in weights]

    def sum_up(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, so_far = TaskContext.get().partitionId(), [0] * len(weights)
        for part in parts:
            if not part.num_rows:
                continue
            sums = [np.cumsum(part.column(w).to_numpy()) + before for w, before in zip(weights, so_far)]
            so_far = [int(s[-1]) for s in sums]
            columns = [*part.columns, *(pa.array(s) for s in sums), pa.array(np.full(part.num_rows, task, np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, *added, "_part"])

    wanted = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema), *(f"{a} long" for a in added), "_part long"])
    summed = materialize(ranged.mapInArrow(sum_up, wanted), "running-sums")
    # One row a partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = summed.groupBy("_part").agg(*[F.max(a).alias(a) for a in added]).select(
        "_part", *[F.coalesce(F.sum(a).over(before), F.lit(0)).alias(f"_{a}") for a in added])
    return summed.join(F.broadcast(offsets), "_part").select(
        *rows.columns, *[(F.col(a) + F.col(f"_{a}")).alias(a) for a in added])


def conversation_trie(turns: DataFrame) -> DataFrame:
    """All nodes of the prefix trie of the rebuilt conversations of (conv_id, turn, role, text).

    Per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (bytes that need not be stored or computed again, over the subtree) and ``ends_sha256``. See
    ``turn_digests`` and ``rebuilt_turns`` for nulls, ties and repeated rows. Other columns are left out. No conversations, no nodes.

    Equal paths are one row before anything else. What spans ranges of paths is at most one path a boundary, so
    corrections (children counted twice, smallest ids of parents) join with that small set, by broadcast only where its measured
    size allows.
    """
    paths = materialize(conversation_paths(turns), "paths")
    distinct = paths.groupBy("path", "sizes").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    sequences = materialize(global_index(materialize(distinct, "sequences"), "path", name="at"), "ranked")
    found = trie_rows(sequences.repartitionByRange("at").sortWithinPartitions("at"))
    nodes = materialize(found.groupBy("node").agg(
        F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.min("size").alias("size"), F.sum("n_convs").alias("n_convs"),
        F.min("conv_id").alias("conv_id"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.min("parent_conv_id").alias("parent_conv_id"), F.sum("n_children").alias("n_children"), F.count("*").alias("copies"),
    ), "nodes")
    spanning = nodes.where("copies > 1")
    above = checked_broadcast(spanning.select(F.col("node").alias("parent"), F.col("conv_id").alias("above")))
    again = checked_broadcast(spanning.where("depth > 0").groupBy(F.col("parent").alias("node")).agg(F.sum(F.col("copies") - 1).alias("again")))
    whole = nodes.join(above, "parent", "left").join(again, "node", "left").select(
        "node", "depth", "first", "last", "n_convs", "conv_id", F.coalesce("above", "parent_conv_id").alias("parent_conv_id"),
        (F.col("n_children") - F.coalesce("again", F.lit(0))).alias("n_children"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
    ).withColumn("leaf", (F.col("n_children") == 0).cast("long"))
    # Preorder is (first path of the node, depth): a subtree ends with the last node that the last path owns.
    summed = materialize(running_sums(materialize(whole, "whole-nodes"), ["first", "depth"], ["leaf", "saved"]), "preorder")
    ends = summed.groupBy(F.col("first").alias("last")).agg(F.max("leaf_up_to").alias("leaf_end"), F.max("saved_up_to").alias("saved_end"))
    return summed.join(ends, "last").join(ends_digests(paths), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("leaf_end") - F.col("leaf_up_to") + F.col("leaf")).alias("n_leaves"),
        (F.col("saved_end") - F.col("saved_up_to") + F.col("saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
