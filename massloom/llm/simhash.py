"""SimHash near-duplicates: binary trie self-join of 64-bit fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from massloom.llm.common import keyed, slices, written
from massloom.llm.graph import components

SHINGLE, SEED, BITS, BUDGET = 3, 42, 64, 2
#: Most fingerprints of a trie leaf; a pair of leaves is one unit of work.
LEAF = 2048
#: Shingles hashed at once, so a very long text needs no more memory than a short one.
BLOCK = 1 << 16
_BIT_OF_BYTE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str, width: int = SHINGLE) -> int:
    """Bit i is 1 if set in over half the hashes of the word shingles, repeats included; no words: 0."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    width = min(width, len(words))
    columns = [words[k:] for k in range(width)]
    total = len(words) - width + 1
    tally = np.zeros((8, 256), dtype=np.int64)
    shingles = map(b" ".join, zip(*columns, strict=False))
    for at in range(0, total, BLOCK):
        n = min(BLOCK, total - at)
        hashes = np.fromiter((xxhash.xxh64_intdigest(next(shingles), SEED) for _ in range(n)), dtype="<u8", count=n)
        lanes = hashes.view(np.uint8).reshape(n, 8) + np.arange(0, 2048, 256, dtype=np.int16)
        tally += np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256)
    ones = (tally @ _BIT_OF_BYTE).ravel()
    return int(((ones * 2 > total).astype(np.uint64) << np.arange(BITS, dtype=np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, fp: the fingerprint as a signed 64-bit number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            fps = np.array([fingerprint(t) for t in part.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(fps)], ["doc_id", "text_key", "fp"])

    return keyed(docs, id_col, text_col).mapInArrow(run, "doc_id long, text_key long, fp long")


def trie_leaves(prints: DataFrame, leaf: int = LEAF) -> list[tuple[int, int]]:
    """The leaves (first fingerprint, depth) of a binary trie whose leaves hold at most ``leaf`` fingerprints.

    Counts are taken for four more bits at a time, under the nodes that are still too full only: there are at
    most (distinct fingerprints / leaf) of those, and only counts of 16 children each reach the driver.
    """
    spark = prints.sparkSession
    leaves: list[tuple[int, int]] = []
    counts = {r[0]: r[1] for r in prints.groupBy(F.shiftrightunsigned("fp", BITS - 4)).count().collect()}
    full, depth = {0: {p: counts.get(p, 0) for p in range(16)}}, 4
    while full:
        heavy = []
        for top, children in full.items():
            # a node of the last step that is small enough, or whose halves all are, becomes a leaf as high up as it can
            todo = [(0, 0)]
            while todo:
                k, at = todo.pop()
                span = 1 << (4 - k)
                size = sum(children.get(c, 0) for c in range(at * span, (at + 1) * span))
                node = (top << k) | at
                if size <= leaf or depth - 4 + k == BITS:
                    leaves.append((node << (BITS - depth + 4 - k), depth - 4 + k))
                elif k == 4:
                    heavy.append(node)
                else:
                    todo += [(k + 1, 2 * at), (k + 1, 2 * at + 1)]
        if not heavy:
            break
        nodes = spark.createDataFrame([(h,) for h in heavy], "node long")
        below = prints.withColumn("node", F.shiftrightunsigned("fp", BITS - depth)).join(nodes, "node")
        rows = below.groupBy("node", F.shiftrightunsigned("fp", BITS - depth - 4).bitwiseAND(15).alias("child")).count().collect()
        full = {h: {} for h in heavy}
        for node, child, n in rows:
            full[node][child] = n
        depth += 4
    return sorted(leaves)


def leaf_pairs(spark: SparkSession, leaves: list[tuple[int, int]], budget: int = BUDGET) -> DataFrame:
    """leaf, pair: each pair of leaves whose common prefix differs in ``budget`` bits at most, under both its leaves."""
    starts = np.array([s for s, _ in leaves], dtype=np.uint64)
    depths = np.array([d for _, d in leaves], dtype=np.int64)

    def partners(k: int) -> list[int]:
        found, todo = [], [(0, len(starts), 0, 0)]
        while todo:
            lo, hi, depth, errors = todo.pop()
            if depth >= depths[k] or hi - lo == 1:
                ends = np.minimum(depths[lo:hi], depths[k])
                differ = (starts[lo:hi] ^ starts[k]) & ~_ones(BITS - ends)
                found += [int(x) for x in np.nonzero(np.bitwise_count(differ) <= budget)[0] + lo]
                continue
            bit = np.uint64(1 << (BITS - 1 - depth))
            mid = lo + int(np.searchsorted((starts[lo:hi] & bit) != 0, True))
            own = bool(starts[k] & bit)
            for a, b, one in ((lo, mid, False), (mid, hi, True)):
                if a < b and errors + (one != own) <= budget:
                    todo.append((a, b, depth + 1, errors + (one != own)))
        return found

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(k, min(k, p) * len(starts) + max(k, p)) for k in batch["id"] for p in partners(int(k))]
            yield pd.DataFrame(out, columns=["leaf", "pair"])

    return spark.range(0, len(leaves)).mapInPandas(run, "leaf long, pair long")


def _ones(bits: np.ndarray) -> np.ndarray:
    """Masks with the low ``bits`` bits set."""
    bits = np.asarray(bits, dtype=np.uint64)
    full = bits >= BITS
    return np.where(full, np.uint64((1 << 64) - 1), (np.uint64(1) << np.where(full, np.uint64(0), bits)) - np.uint64(1))


def trie_join(a: np.ndarray, b: np.ndarray | None = None, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """Positions in sorted ``a`` and ``b`` of fingerprints within ``budget`` bits; with ``b`` None, pairs inside ``a`` once each.

    Both tries are walked together from the root, one bit a step. A node pair carries the bits that differ so far
    and is dropped when they exceed the budget. A pair of single fingerprints is settled by its remaining bits.
    """
    same = b is None
    b = a if same else b
    if not len(a) or not len(b):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    nodes_a = (np.zeros(1, np.int64), np.full(1, len(a)))
    nodes_b = nodes_a if same else (np.zeros(1, np.int64), np.full(1, len(b)))
    i, j, errors = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int8)
    found_a, found_b = [], []
    for depth in range(BITS + 1):
        single = ((nodes_a[1] - nodes_a[0] == 1)[i]) & ((nodes_b[1] - nodes_b[0] == 1)[j])
        if single.any():
            at_a, at_b = nodes_a[0][i[single]], nodes_b[0][j[single]]
            near = np.bitwise_count(a[at_a] ^ b[at_b]) <= budget
            if same:
                near &= at_a != at_b
            found_a.append(at_a[near])
            found_b.append(at_b[near])
            i, j, errors = i[~single], j[~single], errors[~single]
        if not len(i) or depth == BITS:
            break
        nodes_a, zero_a, one_a = _split(a, nodes_a, depth)
        nodes_b, zero_b, one_b = (nodes_a, zero_a, one_a) if same else _split(b, nodes_b, depth)
        steps = [(zero_a[i], zero_b[j], errors), (one_a[i], one_b[j], errors), (zero_a[i], one_b[j], errors + 1)]
        crossed = (one_a[i], zero_b[j], errors + 1)
        if same:  # a node against itself has its crossing once
            crossed = tuple(x[i != j] for x in crossed)
        steps.append(crossed)
        i, j, errors = (np.concatenate(x) for x in zip(*steps, strict=True))
        alive = (i >= 0) & (j >= 0) & (errors <= budget)
        i, j, errors = i[alive], j[alive], errors[alive]
    if not found_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


def _split(values: np.ndarray, nodes: tuple[np.ndarray, np.ndarray], depth: int):
    """The next level's nodes and, for each node of this one, its children's numbers (-1: none)."""
    lo, hi = nodes
    ones = np.concatenate([[0], np.cumsum((values >> np.uint64(BITS - 1 - depth)) & np.uint64(1))]).astype(np.int64)
    mid = hi - (ones[hi] - ones[lo])
    has_zero, has_one = mid > lo, hi > mid
    left, right = np.where(has_zero, 1, 0), np.where(has_one, 1, 0)
    first = np.cumsum(left + right) - (left + right)
    zero, one = np.where(has_zero, first, -1), np.where(has_one, first + left, -1)
    size = int((left + right).sum())
    new_lo, new_hi = np.empty(size, np.int64), np.empty(size, np.int64)
    new_lo[zero[has_zero]], new_hi[zero[has_zero]] = lo[has_zero], mid[has_zero]
    new_lo[one[has_one]], new_hi[one[has_one]] = mid[has_one], hi[has_one]
    return (new_lo, new_hi), zero, one


def forest(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest node of each node's component, for nodes 0 to n-1 and links u-v."""
    label = np.arange(n)
    while True:
        a, b = label[u], label[v]
        open_ = a != b
        if not open_.any():
            return label
        np.minimum.at(label, np.maximum(a, b)[open_], np.minimum(a, b)[open_])
        while (label[label] != label).any():
            label = label[label]


def near_links(prints: DataFrame, leaf: int = LEAF, budget: int = BUDGET) -> DataFrame:
    """u, v: links that join the distinct fingerprints of ``prints`` (column fp) into their components.

    Fingerprints are dealt out by pairs of trie leaves. Of the links found in a pair of leaves only a spanning
    forest leaves the task, so a dense group costs as many rows as it has members.
    """
    spark = prints.sparkSession
    leaves = trie_leaves(prints, leaf)
    starts = np.array([s for s, _ in leaves], dtype=np.uint64)

    def own_leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.searchsorted(starts, fps.view(np.uint64), "right") - 1)], ["fp", "leaf"])

    def link(key: tuple[pa.Scalar, ...], frame: pa.Table) -> pa.Table:
        fps, sides = frame.column("fp").to_numpy().view(np.uint64), frame.column("leaf").to_numpy()
        first = sides == sides.min()
        if first.all():
            if key[0].as_py() // len(starts) != key[0].as_py() % len(starts):  # the other leaf is empty
                return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
            both = np.sort(fps)
            u, v = trie_join(both, None, budget)
        else:
            a, b = np.sort(fps[first]), np.sort(fps[~first])
            both = np.concatenate([a, b])
            u, v = trie_join(a, b, budget)
            v = v + len(a)
        label = forest(len(both), u, v)
        member = np.nonzero(label != np.arange(len(both)))[0]
        return pa.table({"u": both[member].view(np.int64), "v": both[label[member]].view(np.int64)})

    placed = prints.select("fp").mapInArrow(own_leaf, "fp long, leaf long")
    pairs = leaf_pairs(spark, leaves, budget)
    return placed.join(pairs, "leaf").groupBy("pair").applyInArrow(link, "u long, v long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, leaf: int = LEAF, budget: int = BUDGET) -> DataFrame:
    """Near-duplicate groups: documents whose SimHash fingerprints are linked, directly or by others, at ``budget`` bits.

    Result: doc_id, text_key, fingerprint (16 hex digits), component_id (smallest doc_id reachable).
    Null, empty and blank texts have fingerprint zero and link like any other. One row per row of the input, repeated
    rows too; a null doc_id gets its component but never names one, unless all of it have none. An empty table gives
    no rows. Each distinct fingerprint takes part in the join once, so exact copies are never paired.
    """
    rows = written(fingerprints(docs, id_col, text_col))
    prints = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    found = components(near_links(prints.select("fp"), leaf, budget))
    classes = prints.join(found, prints["fp"] == found["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    ids = classes.join(classes.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("fp", "component_id")
    return rows.join(ids, "fp").select("doc_id", "text_key", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
