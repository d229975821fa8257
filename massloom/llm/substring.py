"""Duplicate passages by content-defined blocks and window hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from massloom.llm.common import keyed, release, slices, written

#: Words of the shortest factor, words of an anchor.
WINDOW, ANCHOR = 13, 5
#: Blocks summed up in a task before they are sent.
FLUSH = 400_000
#: Bytes of a text hashed at once.
BLOCK = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


class _Powers:
    """Powers of an odd multiplier modulo 2^64 and of its inverse, as long as the longest text so far."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            steps = np.repeat(np.array([[self.base], [self.inverse]], dtype=np.uint64), n, axis=1)
            steps[:, 0] = 1
            self.up, self.down = np.cumprod(steps, axis=1, dtype=np.uint64)


_FIRST, _SECOND, _THIRD = _Powers(0xC2B2AE3D27D4EB4F), _Powers(0x165667B19E3779F9), _Powers(0x27D4EB2F165667C5)


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def _sums(tokens: np.ndarray, powers: _Powers) -> np.ndarray:
    powers.reach(len(tokens) + 1)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(tokens * powers.up[:len(tokens)])])


def _grams(sums: np.ndarray, n: int, powers: _Powers) -> np.ndarray:
    """Hash of every run of ``n`` words, wherever it stands, from the running sums."""
    size = len(sums) - n
    return _finish((sums[n:] - sums[:size]) * powers.down[:size])


def windows(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every window."""
    return _grams(_sums(tokens, _FIRST), WINDOW, _FIRST), _grams(_sums(tokens, _SECOND), WINDOW, _SECOND)


def blocks(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, anchor hash and content hash of each block.

    A block is a run of windows with one anchor: the smallest of their word five-grams by hash, the leftmost
    of equal ones (60 bits are compared). Where a block begins and ends depends on its words alone, so a passage that occurs twice
    has the same blocks, but for those at its ends.
    """
    none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    if len(tokens) < WINDOW:
        return none
    sums = _sums(tokens, _FIRST)
    grams = _grams(sums, ANCHOR, _FIRST)
    size = len(tokens) - WINDOW + 1
    # the low four bits make way for the place in the window, so equal hashes go to the left
    cut = grams & ~np.uint64(15)
    best = cut[:size].copy()
    for k in range(1, WINDOW - ANCHOR + 1):
        np.minimum(best, cut[k:k + size] | np.uint64(k), out=best)
    place = np.arange(size) + (best & np.uint64(15)).astype(np.int64)
    first = np.nonzero(np.concatenate([[True], place[1:] != place[:-1]]))[0]
    count = np.diff(np.concatenate([first, [size]]))
    content = _finish((sums[first + count + WINDOW - 1] - sums[first]) * _FIRST.down[first] * _MIX + (place[first] - first).astype(np.uint64) * np.uint64(16) + count.astype(np.uint64))
    return first, count, grams[place[first]], content


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTES = np.random.default_rng(0).integers(0, 1 << 64, 256, dtype=np.uint64)


def _tokens(text: str) -> np.ndarray:
    """A 64-bit hash of each word, from running sums over the bytes; a long text goes block by block."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    found, at = [], 0
    while at < len(data):
        end = min(at + BLOCK, len(data))
        while end < len(data) and not _SPACE[data[end]]:  # to the end of the word
            more = np.nonzero(_SPACE[data[end:end + BLOCK]])[0]
            end = end + int(more[0]) if len(more) else min(end + BLOCK, len(data))
        part = data[at:end]
        inside = np.concatenate([[False], ~_SPACE[part], [False]])
        edges = np.nonzero(inside[1:] != inside[:-1])[0]
        sums, starts = _sums(_BYTES[part], _THIRD), edges[::2]
        found.append(_finish((sums[edges[1::2]] - sums[starts]) * _THIRD.down[starts]))
        at = end
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _index_rows(docs: DataFrame) -> DataFrame:
    """anchor, content, first, last: smallest and largest doc_id with the block, summed up within a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            anchor, content, doc = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((doc, content, anchor))
            anchor, content, doc = anchor[order], content[order], doc[order]
            new = np.nonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])]))[0]
            last = np.concatenate([new[1:], [len(doc)]]) - 1
            return pa.RecordBatch.from_arrays([_signed(anchor[new]), _signed(content[new]), pa.array(doc[new]), pa.array(doc[last])], ["anchor", "content", "first", "last"])

        for part in slices(batches):
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                _, _, anchor, content = blocks(_tokens(text))
                if len(anchor):
                    held.append((anchor, content, np.full(len(anchor), doc_id, dtype=np.int64)))
                    size += len(anchor)
                    if size >= FLUSH:
                        yield flush()
                        held, size = [], 0
        if held:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(run, "anchor long, content long, first long, last long")


def _places(docs: DataFrame) -> DataFrame:
    """anchor, content, doc_id, text_key, place (first window * 16 + windows) of every block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = []
            for doc_id, text, key in zip(*(c.to_pylist() for c in part.columns), strict=True):
                first, count, anchor, content = blocks(_tokens(text))
                if len(first):
                    rows.append((anchor.view(np.int64), content.view(np.int64), np.full(len(first), doc_id), np.full(len(first), key), first * 16 + count))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*rows, strict=True)], ["anchor", "content", "doc_id", "text_key", "place"])

    return docs.select("doc_id", "text", "text_key").mapInArrow(run, "anchor long, content long, doc_id long, text_key long, place long")


def _by_document(places: DataFrame) -> DataFrame:
    return places.groupBy("doc_id", "text_key").agg(F.collect_list("place").alias("places"))


def _windows_at(docs: DataFrame) -> DataFrame:
    """w1, w2, doc_id, text_key, place (window * 16 + 1) for the windows of the blocks in ``places``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = []
            for doc_id, text, key, places in zip(*(c.to_pylist() for c in part.columns), strict=True):
                w1, w2 = windows(_tokens(text))
                at = _spread(np.array(places, dtype=np.int64))
                rows.append((w1[at].view(np.int64), w2[at].view(np.int64), np.full(len(at), doc_id), np.full(len(at), key), at * 16 + 1))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*rows, strict=True)], ["w1", "w2", "doc_id", "text_key", "place"])

    return docs.select("doc_id", "text", "text_key", "places").mapInArrow(run, "w1 long, w2 long, doc_id long, text_key long, place long")


def _spread(places: np.ndarray) -> np.ndarray:
    """Window numbers of packed places."""
    first, count = places >> 4, places & 15
    return np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())


def _parsed(docs: DataFrame) -> DataFrame:
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(span), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out = []
            for doc_id, text, key, places in zip(*(c.to_pylist() for c in part.columns), strict=True):
                found = words(text)
                edge = np.zeros(len(found) + 1, dtype=np.int64)
                if places:
                    at = _spread(np.array(places, dtype=np.int64))
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + WINDOW, -1)
                covered = np.cumsum(edge[:-1]) > 0
                change = np.nonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))[0]
                kept = b" ".join(w for w, c in zip(found, covered.tolist(), strict=True) if not c) if places else b" ".join(found)
                out.append((doc_id, key, len(found), int(covered.sum()), [{"start": a, "end": b} for a, b in change.reshape(-1, 2).tolist()], kept.decode("utf-8", "replace")))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "text_key", "n_words", "n_removed", "factors", "kept_text"])

    return docs.select("doc_id", "text", "text_key", "places").mapInArrow(run, "doc_id long, text_key long, n_words long, n_removed long, factors array<struct<start:int,end:int>>, kept_text string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text without the words of passages (13 words or more) that also start in a document with a smaller doc_id.

    Every document is cut into content-defined reference blocks, and all blocks are indexed by anchor and content
    with the smallest doc_id that has them. An equality join marks the blocks of a document whose content occurs
    earlier. Where blocks share an anchor but not all of their words, the single windows of each block's first
    document are joined by their hashes. What the marked windows cover is removed. This stands in for greedy relative
    Lempel-Ziv factoring, which would need the reference text in the task of each document.

    Blocks are summed up in each task before they are sent, so a passage that a third of the documents carry
    costs a row per task. Contents are compared by 128 bits of hash (64 of the anchor, 64 of the rest).

    Result: doc_id, text_key, n_words, n_removed, factors (start, end in words), kept_text (kept words joined by one
    space). One row per row of the input. Null and empty texts have no words. A null doc_id is neither source nor
    target: its text stays. Rows that repeat a doc_id do not count against each other. An empty table gives no rows.
    """
    rows = keyed(docs, id_col, text_col)
    known = rows.filter("doc_id IS NOT NULL")
    contents = _index_rows(known).repartition("anchor").groupBy("anchor", "content").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    by_anchor = Window.partitionBy("anchor")
    shared = contents.select("anchor", "content", "first", F.min("first").over(by_anchor).alias("a"), F.max("last").over(by_anchor).alias("z"), (F.count("*").over(by_anchor) > 1).alias("mixed"))
    shared = written(shared.filter("a < z").select("anchor", "content", "first", "mixed"))
    release(rows.sparkSession)
    found = _places(known).join(shared, ["anchor", "content"]).filter("mixed OR doc_id > first").select("doc_id", "text_key", "place", (F.col("doc_id") > F.col("first")).alias("repeat"))
    found = written(found)
    release(rows.sparkSession)
    edges = known.join(_by_document(found.filter("NOT repeat")), ["doc_id", "text_key"])
    single = written(_windows_at(edges))
    release(rows.sparkSession)
    earliest = written(single.groupBy("w1", "w2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last").drop("last"))
    late = single.join(earliest, ["w1", "w2"]).filter("doc_id > first").select("doc_id", "text_key", "place")
    marks = _by_document(found.filter("repeat").select("doc_id", "text_key", "place").union(late))
    return _parsed(rows.join(marks, ["doc_id", "text_key"], "left"))
