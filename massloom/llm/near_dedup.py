"""Near-duplicates by the Jaccard similarity of word shingles: a binary trie of SimHash fingerprints and banded minima choose
candidates, class counts rule out most, the shingle sets decide."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from massloom.llm.common import dropped, keyed, slices, written
from massloom.llm.graph import components
from massloom.llm.simhash import BUDGET, fingerprint, near_links

#: Words of a shingle, and the least share of common shingles as a fraction.
SHINGLE, SIMILARITY = 5, (4, 5)
#: Bands and minima in each: two texts of similarity 0.8 share no band with chance (1 - 0.8^4)^32, below 1e-7.
BANDS, ROWS = 32, 4
#: Shingles hashed at once.
BLOCK = 1 << 12
#: Classes that shingles are counted in, and members of a bucket compared at once.
CLASSES, MEMBERS = 256, 256
_FACTORS = np.random.default_rng(42).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str, width: int = SHINGLE) -> set[bytes]:
    """Distinct runs of ``width`` lower-case words; a shorter text is one shingle, no words none."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    width = min(width, len(words))
    return set(map(b" ".join, zip(*[words[k:] for k in range(width)], strict=False))) if words else set()


def similar(a: set[bytes], b: set[bytes], similarity: tuple[int, int] = SIMILARITY) -> bool:
    """Whether common over all shingles reach the similarity; texts without words are equal."""
    common = len(a & b)
    return common * similarity[1] >= (len(a) + len(b) - common) * similarity[0]


def _mark(text: str, width: int) -> tuple[bytes, int, np.ndarray, bytes]:
    """Of a text's shingle set: a 128-bit digest, the size, a number for each band (a hash of its minima under its
    multipliers), and how many shingles fall in each class."""
    found = shingles(text, width)
    wide = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, found)), dtype=np.uint64).reshape(-1, 2)
    hashes = wide[:, 0]
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), BLOCK):
        least = np.minimum(least, (hashes[at:at + BLOCK, None] * _FACTORS).min(0))
    out = np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX
    for column in least.reshape(BANDS, ROWS).T:
        out = (out ^ column) * _MIX
        out ^= out >> np.uint64(31)
    counts = np.bincount((wide[:, 1] % np.uint64(CLASSES)).astype(np.int64), minlength=CLASSES).astype(np.int32)
    ordered = wide[np.lexsort((wide[:, 1], hashes))]
    return hashlib.blake2b(ordered.tobytes(), digest_size=16).digest(), len(found), out.view(np.int64), counts.tobytes()


def _marked(rows: DataFrame, width: int) -> DataFrame:
    """Each text's ``_mark`` and ``fp``, its SimHash fingerprint over the same shingles as a signed number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column(1).to_pylist()
            found = [_mark(t, width) for t in texts]
            fps = np.array([fingerprint(t, width) for t in texts], dtype=np.uint64).view(np.int64)
            columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), *columns, pa.array(fps)], ["doc_id", "text_key", "digest", "n", "bands", "counts", "fp"])

    return rows.select("doc_id", "text", "text_key").mapInArrow(run, "doc_id long, text_key long, digest binary, n long, bands array<long>, counts binary, fp long")


def _buckets(nodes: DataFrame, budget: int = BUDGET) -> DataFrame:
    """node, n, band: the buckets in which nodes are candidates. One for each of a node's bands, and one for the component of
    its fingerprint in the trie self-join at ``budget`` bits."""
    prints = written(nodes.select("fp").distinct())
    found = components(near_links(prints, budget=budget)).withColumnRenamed("node", "of")
    trie = nodes.select("node", "n", "fp").join(found, F.col("fp") == F.col("of"), "left")
    return nodes.select("node", "n", F.explode("bands").alias("band")).union(trie.select("node", "n", F.xxhash64(F.lit("trie"), F.coalesce("root", "fp"))))


def _sizes_allow(a: Column, b: Column, similarity: tuple[int, int]) -> Column:
    return F.least(a, b) * similarity[1] >= F.greatest(a, b) * similarity[0]


def _possible(most_common: np.ndarray, sizes: np.ndarray, similarity: tuple[int, int]) -> np.ndarray:
    return most_common * similarity[1] >= (sizes - most_common) * similarity[0]


def _verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, similarity: tuple[int, int]) -> DataFrame:
    """The pairs (u, v) of nodes whose texts are similar. Two texts have no more shingles in common than the smaller
    counts of all classes add up to; only pairs that this leaves have their texts brought together."""
    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            a, b = (np.frombuffer(b"".join(part.column(k).to_pylist()), dtype=np.int32).reshape(-1, CLASSES) for k in (2, 3))
            keep = _possible(np.minimum(a, b).sum(1, dtype=np.int64), a.sum(1, dtype=np.int64) + b.sum(1, dtype=np.int64), similarity)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in part.columns[:2]], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int | None, set[bytes]] = (None, set())
        for part in slices(batches):
            keep = []
            for v, a, b in zip(*(c.to_pylist() for c in part.columns[1:]), strict=True):
                if v != last[0]:
                    last = (v, shingles(b, width))
                keep.append(similar(shingles(a, width), last[1], similarity))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in part.columns[:2]], ["u", "v"])

    counted = lambda end, name: nodes.select(F.col("node").alias(end), F.col("counts").alias(name))
    near = written(pairs.join(counted("u", "a"), "u").join(counted("v", "b"), "v").select("u", "v", "a", "b").mapInArrow(left, "u long, v long"))
    one = texts.select(F.col("node").alias("u"), F.col("text").alias("a"))
    two = texts.select(F.col("node").alias("v"), F.col("text").alias("b"))
    links = written(near.join(one, "u").join(two, "v").select("u", "v", "a", "b").mapInArrow(run, "u long, v long"))
    dropped(near)
    return links


def _apart(rooted: DataFrame, nodes: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs (u, v) of one bucket in two components that the class counts allow.

    A bucket is dealt out into parts of about ``MEMBERS``, and every two of its parts are compared in one place, so a
    member is sent once for each part; what comes out are the few pairs that are left.
    """
    parts = rooted.groupBy("band").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("parts"))
    member = rooted.join(parts, "band").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    member = member.select("band", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "node", "root")
    member = member.join(nodes.select("node", "counts"), "node").select("band", "low", "high", "part", "node", "root", "counts")

    def pairs(rows: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
        low, high, part, node, root = (rows.column(k).to_numpy() for k in range(1, 6))
        counts = np.frombuffer(b"".join(rows.column(6).to_pylist()), dtype=np.int32).reshape(-1, CLASSES)
        sizes, out = counts.sum(1, dtype=np.int64), []
        counts = counts.astype(np.uint16) if sizes.max(initial=0) < 1 << 16 else counts
        for i in range(len(node) - 1):
            other = (root[i + 1:] != root[i]) & ((low[0] == high[0]) | (part[i + 1:] != part[i]))
            other &= _possible(np.minimum(sizes[i], sizes[i + 1:]), sizes[i] + sizes[i + 1:], similarity)
            at = np.flatnonzero(other) + i + 1
            if len(at):
                at = at[_possible(np.minimum(counts[i], counts[at]).sum(1, dtype=np.int64), sizes[i] + sizes[at], similarity)]
                out.append((np.minimum(node[i], node[at]), np.maximum(node[i], node[at])))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None

        def closed() -> Iterator[pa.RecordBatch]:
            found = pairs(pa.Table.from_batches(held))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[k] for x in found])) for k in (0, 1)], ["u", "v"])

        for part in slices(batches, 4096):
            keys = np.stack([part.column(k).to_numpy() for k in range(3)])
            starts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), part.num_rows]
            for a, b in zip(starts, starts[1:], strict=False):
                now = tuple(keys[:, a].tolist())
                if held and now != key:
                    yield from closed()
                    held = []
                key = now
                held.append(part.slice(a, b - a))
        if held:
            yield from closed()

    place = ["band", "low", "high"]
    return member.repartition(*place).sortWithinPartitions(*place).mapInArrow(run, "u long, v long").distinct()


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """Near-duplicate groups: documents linked, directly or by others, by an exact similarity of their shingle sets.

    Texts of equal shingle sets (128-bit digests) are one node. Nodes that share a band, or whose fingerprints the trie
    self-join of SimHash links, are candidates. In each bucket of these all nodes are first compared with the smallest, then those of other components with the largest, then
    all that are still in two components, in blocks that put out only pairs which their class counts allow; so a dense
    group costs as many rows as it has members, and no candidate pair of two groups is left out.

    Result: doc_id, text_key, component_id (smallest doc_id reachable), kept (the row that stays: smallest doc_id, of
    several texts under it the one of smallest text_key). Null, empty and blank texts are one group. One row per row
    of the input, repeated rows too; a null doc_id gets its component but never names one, unless all of it have none;
    then one text of them is kept. An empty table gives no rows.
    """
    rows = keyed(docs, id_col, text_col)
    marked = written(_marked(rows, width))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    nodes = marked.groupBy("digest").agg(first, F.first(F.struct("n", "bands", "counts")).alias("of"), F.min("fp").alias("fp"))
    nodes = written(nodes.select(F.monotonically_increasing_id().alias("node"), "digest", "first", "of.*", "fp"))
    buckets = written(_buckets(nodes))
    ends = buckets.groupBy("band").agg(F.min(F.struct("node", "n")).alias("lo"), F.max(F.struct("node", "n")).alias("hi")).filter("lo.node < hi.node")
    member = written(buckets.join(ends, "band"))
    dropped(buckets)
    needed = nodes.join(member.select("node").distinct(), "node", "left_semi").select("node", F.col("first.doc_id").alias("at_id"), F.col("first.text_key").alias("at_key"))
    texts = rows.join(needed, rows["doc_id"].eqNullSafe(needed["at_id"]) & (rows["text_key"] == needed["at_key"]))
    texts = written(texts.select("node", "text").dropDuplicates(["node"]))

    def hub(bucket: DataFrame, end: str) -> DataFrame:
        near = bucket.filter((F.col("node") != F.col(f"{end}.node")) & _sizes_allow(F.col("n"), F.col(f"{end}.n"), similarity))
        return near.select(F.col("node").alias("u"), F.col(f"{end}.node").alias("v")).distinct()

    def unsettled(links: DataFrame) -> DataFrame:
        """Members of the buckets that lie in several components."""
        found = components(links)
        rooted = member.join(found.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").withColumn("root", F.coalesce("root", "node")).drop("of")
        mixed = rooted.groupBy("band").agg(F.min("root").alias("r"), F.max("root").alias("s")).filter("r < s").select("band")
        return written(rooted.join(mixed, "band"))

    links = _verified(hub(member, "lo"), nodes, texts, width, similarity)
    rooted = unsettled(links)
    ends = rooted.filter("node = hi.node").select("band", F.col("root").alias("hub_root"))
    links = links.union(_verified(hub(rooted.join(ends, "band").filter("root <> hub_root AND node <> lo.node"), "hi"), nodes, texts, width, similarity))
    dropped(rooted)
    rooted = unsettled(links)
    rest = rooted.filter("node <> lo.node AND node <> hi.node").select("band", "node", "root")
    links = links.union(_verified(_apart(rest, nodes, similarity), nodes, texts, width, similarity))
    dropped(rooted, texts)
    found = components(links)
    dropped(member)
    classes = written(nodes.join(found.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").select("digest", "first", F.coalesce("root", "node").alias("root")))
    firsts = classes.groupBy("root").agg(F.min("first").alias("stays"))
    stays = classes.join(firsts, "root").select("digest", F.col("stays.doc_id").alias("component_id"), F.col("stays.text_key").alias("stays_key"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_key") == F.col("stays_key"))
    return marked.select("doc_id", "text_key", "digest").join(stays, "digest").select("doc_id", "text_key", "component_id", kept.alias("kept"))
