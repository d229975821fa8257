"""Prefix trie of conversations: adaptive radix trees over ranges of turn-id keys, joined along the paths that ranges share."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from massloom.llm.common import release, slices, text_of, written

#: Bytes of a turn id: the first half of a SHA-256, big end first.
WIDTH = 16
#: Turns held in one tree; a range of more is cut into several trees.
BLOCK_TURNS = 1 << 17
#: Conversation ids in one piece of a digest's input.
PIECE = 256
ROWS = "node_id binary, parent_id binary, parent_open boolean, is_open boolean, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, turn_bytes long"


class Node:
    """An inner node or leaf: the compressed path in front of it, the key that ends at it, and its children.

    The layout grows with the number of children: up to 4 and up to 16 sorted bytes beside a list, up to 48 through a
    table of 256 positions, then one place for each byte.
    """

    __slots__ = ("path", "ended", "bytes", "kids", "layout")

    def __init__(self, path: bytes, ended: tuple | None = None) -> None:
        self.path, self.ended, self.layout = path, ended, 4
        self.bytes: bytearray | None = bytearray()
        self.kids: list = []

    def child(self, byte: int) -> Node | None:
        if self.layout <= 16:
            at = self.bytes.find(byte)
            return self.kids[at] if at >= 0 else None
        if self.layout == 48:
            at = self.bytes[byte]
            return self.kids[at - 1] if at else None
        return self.kids[byte]

    def put(self, byte: int, child: Node) -> None:
        """A new child, or another in the place of an old one."""
        if self.layout <= 16:
            at = self.bytes.find(byte)
            if at >= 0:
                self.kids[at] = child
                return
            if len(self.kids) < self.layout:
                at = sum(b < byte for b in self.bytes)
                self.bytes.insert(at, byte)
                self.kids.insert(at, child)
                return
            if self.layout == 4:
                self.layout = 16
            else:
                table = bytearray(256)
                for place, known in enumerate(self.bytes, 1):
                    table[known] = place
                self.bytes, self.layout = table, 48
            self.put(byte, child)
        elif self.layout == 48:
            at = self.bytes[byte]
            if at:
                self.kids[at - 1] = child
            elif len(self.kids) < 48:
                self.kids.append(child)
                self.bytes[byte] = len(self.kids)
            else:
                places = [self.kids[p - 1] if p else None for p in self.bytes]
                self.kids, self.bytes, self.layout = places, None, 256
                self.put(byte, child)
        else:
            self.kids[byte] = child

    def children(self) -> Iterator[tuple[int, Node]]:
        """In the order of their bytes."""
        if self.layout <= 16:
            yield from zip(self.bytes, self.kids, strict=True)
        elif self.layout == 48:
            yield from ((b, self.kids[p - 1]) for b, p in enumerate(self.bytes) if p)
        else:
            yield from ((b, k) for b, k in enumerate(self.kids) if k is not None)


def _common(a: bytes, b: bytes, at: int) -> int:
    """Bytes of ``a`` that ``b`` repeats from ``at`` on."""
    if b.startswith(a, at):
        return len(a)
    lo, hi = 0, min(len(a), len(b) - at)
    while lo < hi:
        half = (lo + hi + 1) // 2
        lo, hi = (half, hi) if b.startswith(a[:half], at) else (lo, half - 1)
    return lo


def insert(root: Node, key: bytes, ended: tuple) -> None:
    node, above, edge, at = root, None, 0, 0
    while True:
        same = _common(node.path, key, at)
        if same < len(node.path):
            split = Node(node.path[:same])
            split.put(node.path[same], node)
            node.path = node.path[same + 1:]
            above.put(edge, split)
            node = split
        at += same
        if at == len(key):
            node.ended = ended
            return
        below = node.child(key[at])
        if below is None:
            node.put(key[at], Node(key[at + 1:], ended))
            return
        above, edge, node, at = node, key[at], below, at + 1


def emit(root: Node, first: bytes, last: bytes, width: int = WIDTH) -> list[tuple]:
    """A row (see ``ROWS``) for each turn-aligned depth of the tree, the root at depth 0 included.

    Nodes on the paths of the tree's first and last key are open: other trees may hold a part of them. An open row
    carries what its own tree adds, without what hangs under open nodes below it.
    """
    rows: list[list] = []
    # a frame: node, bytes above its path, its bytes shared with first and last, hash above, children to come, what came up
    def frame(node: Node, edge: bytes, start: int, on: tuple[int, int], digest: hashlib._Hash) -> list:
        piece, shared = edge + node.path, []
        for bound, known in zip((first, last), on, strict=True):
            shared.append(known + _common(piece, bound, known) if known == start else known)
        marks, state, at = [], digest.copy(), 0
        for aligned in range(-(-(start + 1) // width) * width, start + len(piece) + 1, width):
            state.update(piece[at:aligned - start])
            at = aligned - start
            marks.append((aligned // width, state.digest()[:WIDTH], aligned <= max(shared)))
        state.update(piece[at:])
        return [node, start + len(piece), tuple(shared), state, node.children(), [0, None, 0, 0, 0, [], node.ended], marks]

    top = frame(root, b"", 0, (0, 0), hashlib.sha256())
    top[6] = [(0, hashlib.sha256().digest()[:WIDTH], True)]
    stack = [top]
    while stack:
        node, end, shared, state, kids, up, marks = stack[-1]
        step = next(kids, None)
        if step is not None:
            stack.append(frame(step[1], bytes([step[0]]), end, shared, state))
            continue
        stack.pop()
        if node.ended:
            up[0] += node.ended[0]
            up[1] = node.ended[1] if up[1] is None else min(up[1], node.ended[1])
        n, least, children, leaves, saved, below, sample = up
        for depth, node_id, is_open in reversed(marks):
            size = sample[2][depth - 1] if depth else 0
            if not is_open:
                leaves, saved = leaves if children else 1, saved + (n - 1) * size
            for row in below:
                row[1], row[2], row[6] = node_id, is_open, None if is_open else least
            rows.append([node_id, None, None, is_open, least, depth, None, n, children, leaves, saved, size])
            below = [rows[-1]]
            children, leaves, saved = (0, 0, 0) if is_open else (1, leaves, saved)
        if stack:
            to = stack[-1][5]
            to[0] += n
            to[1] = least if to[1] is None else min(to[1], least)
            to[2], to[3], to[4] = to[2] + children, to[3] + leaves, to[4] + saved
            to[5] += below
            to[6] = to[6] or sample
    return rows


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted keys into trees of bounded size, each tree into its rows."""
    schema = pa.schema([(name, {"binary": pa.binary(), "boolean": pa.bool_(), "long": pa.int64()}[kind]) for name, kind in (c.split() for c in ROWS.split(", "))])
    root, first, last, held = None, b"", b"", 0

    def closed() -> Iterator[pa.RecordBatch]:
        rows = emit(root, first, last)
        for at in range(0, len(rows), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[at:at + 4096], strict=True), schema, strict=True)], schema=schema)

    for part in slices(batches):
        for key, n, least, sizes in zip(*(c.to_pylist() for c in part.columns), strict=True):
            if root is None:
                root, first, held = Node(b""), key, 0
            insert(root, key, (n, least, sizes))
            last, held = key, held + 1 + len(sizes)
            if held >= BLOCK_TURNS:
                yield from closed()
                root = None
    if root is not None:
        yield from closed()


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one node in sorted (node_id, conv_id) as comma-joined pieces."""
    held: tuple[bytes | None, list[int]] = (None, [])
    for part in slices(batches, 4096):
        out = []
        for node, conv in zip(*(c.to_pylist() for c in part.columns), strict=True):
            if node != held[0] or len(held[1]) == PIECE:
                out.append(held)
                held = (node, [])
            held[1].append(conv)
        out = [x for x in out if x[1]]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1][0] for x in out], pa.int64()), pa.array([",".join(map(str, x[1])) for x in out], pa.string())], ["node_id", "least", "ids"])
    if held[1]:
        yield pa.RecordBatch.from_arrays([pa.array([held[0]], pa.binary()), pa.array([held[1][0]], pa.int64()), pa.array([",".join(map(str, held[1]))], pa.string())], ["node_id", "least", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces, one SHA-256 for each node, fed piece by piece."""
    node, state = None, None
    for part in slices(batches):
        out = []
        for at, ids in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), strict=True):
            if at == node:
                state.update(b"," + ids.encode())
                continue
            if node is not None:
                out.append((node, state.hexdigest()))
            node, state = at, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.string())], ["node_id", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["node_id", "ends_sha256"])


def _settled(partial: DataFrame) -> DataFrame:
    """Open nodes whole: the parts of all trees added up, then subtree sums by doubling the distance to the ancestor
    that takes a node's sum, in as many rounds as the longest path has binary digits."""
    total = lambda c: F.sum(c).alias(c)
    merged = written(partial.groupBy("node_id", "parent_id", "depth", "turn_bytes").agg(F.min("conv_id").alias("conv_id"), total("n_convs"), total("n_children"), total("n_leaves"), total("saved_tokens")))
    kids = merged.filter("parent_id IS NOT NULL").groupBy(F.col("parent_id").alias("node_id")).agg(F.count("*").alias("open_kids"), F.lit(True).alias("has"))
    merged = merged.join(kids, "node_id", "left").withColumn("n_children", F.col("n_children") + F.coalesce("open_kids", F.lit(0)))
    merged = written(merged.withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves"))).withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("turn_bytes")))
    sums = merged.select("node_id", F.col("parent_id").alias("anc"), "n_leaves", "saved_tokens")
    reach, longest = 1, merged.agg(F.max("depth")).first()[0] or 0
    while reach <= longest:
        came = sums.filter("anc IS NOT NULL").groupBy(F.col("anc").alias("node_id")).agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
        further = sums.select(F.col("node_id").alias("anc"), F.col("anc").alias("next"))
        sums = written(sums.join(came, "node_id", "left").join(further, "anc", "left").select(
            "node_id", F.col("next").alias("anc"), (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"), (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens")))
        reach *= 2
    merged = merged.drop("n_leaves", "saved_tokens").join(sums.drop("anc"), "node_id")
    above = merged.select(F.col("node_id").alias("parent_id"), F.col("conv_id").alias("parent_conv_id"))
    return written(merged.join(above, "parent_id", "left"))


def turn_ids(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turns: the ordered turns of each conversation as (turn_id hex, text bytes); texts go no further.

    Turns are ordered by number, null first; equal numbers by turn id. Null roles and texts are empty. Rows without a
    conv_id belong to none.
    """
    role, text = text_of(role_col), text_of(text_col)
    name = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    one = F.struct(F.col(turn_col).isNotNull().alias("known"), F.coalesce(F.col(turn_col).cast("long"), F.lit(0)).alias("turn"), F.substring(F.sha2(name, 256), 1, 2 * WIDTH).alias("turn_id"), F.octet_length(text).cast("long").alias("bytes"))
    listed = rows.filter(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv_id"), one.alias("one"))
    return listed.groupBy("conv_id").agg(F.array_sort(F.collect_list("one")).alias("turns")).select("conv_id", F.transform("turns", lambda t: F.struct(t["turn_id"].alias("turn_id"), t["bytes"].alias("bytes"))).alias("turns"))


def with_donor_heads(sequences: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """Conversations rebuilt: the first h turns of conversation c - c % every, then c's own turns behind its first h,
    where h is crc32 of the decimal c modulo ``most``."""
    h: Column = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    heads = sequences.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("donor"), F.slice("turns", 1, most - 1).alias("head"))
    own = sequences.withColumn("donor", F.col("conv_id") - F.col("conv_id") % every).withColumn("h", h)
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    return own.join(heads, "donor", "left").select("conv_id", F.concat(head, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """Every distinct prefix of the conversations in ``sequences`` (conv_id long, turns array of (turn_id hex, bytes)).

    A conversation becomes a key of fixed-width turn ids. Equal keys are counted first, so copies weigh as one row;
    the distinct keys are dealt out by range and sorted, and each task grows adaptive radix trees of bounded size over
    its range and emits the nodes at turn-aligned depths. Only the paths of a tree's first and last key can go on in
    another tree; those nodes are added up afterwards by Spark. Ids that end at a node are sorted by range, joined in
    pieces and fed to one digest.

    Result, a row for each node: node_id (half a SHA-256 of the turn ids), parent_id, conv_id (smallest member), depth,
    parent_conv_id (null at the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Conversations without
    turns are members of the root only. Repeated conv_ids in ``sequences`` are members as often as they occur. An
    empty table gives no rows. One conversation is one key and so one row, of 16 bytes a turn.
    """
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["turn_id"]), ""))
    keyed = written(sequences.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["bytes"]).alias("sizes")))
    keys = written(keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"), F.first("sizes").alias("sizes")))
    nodes = written(keys.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(_grow, ROWS))
    release(keyed.sparkSession)
    spine = _settled(nodes.filter("is_open"))
    whole = ["node_id", "parent_id", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    above = spine.select(F.col("node_id").alias("parent_id"), F.col("conv_id").alias("parent_conv_id"))
    hung = nodes.filter("NOT is_open AND parent_open").drop("parent_conv_id").join(above, "parent_id")
    every = nodes.filter("NOT is_open AND NOT parent_open").select(*whole).union(hung.select(*whole)).union(spine.select(*whole))
    ends = keyed.select(F.unhex(F.substring(F.sha2("key", 256), 1, 2 * WIDTH)).alias("node_id"), "conv_id")
    ends = ends.repartitionByRange("node_id", "conv_id").sortWithinPartitions("node_id", "conv_id").mapInArrow(_pieces, "node_id binary, least long, ids string")
    ends = ends.repartition("node_id").sortWithinPartitions("node_id", "least").mapInArrow(_digests, "node_id binary, ends_sha256 string")
    return every.join(ends, "node_id", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))
