"""Benchmark decontamination by spaced-seed hashing."""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from massloom.llm.common import keyed, slices

#: Words of a window, and how many of them must agree.
WINDOW, SIMILARITY = 13, 0.8
#: Benchmark items with fewer words than this are no evidence; those shorter than a window are one window.
SHORTEST = 8
#: Benchmark words searched for in one scan of the documents; larger benchmarks are searched block by block.
BLOCK_WORDS = 250_000
_WORD = re.compile(r"\w+")
_BITS = 20
_MEMO = 1 << 20


class _Hashes(dict):
    """64-bit hash by word; keeps the words seen first."""

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) < _MEMO:
            self[word] = value
        return value


def words(text: str, hashes: _Hashes) -> np.ndarray:
    """Hashes of the lower-case words."""
    found = _WORD.findall(text.lower())
    return np.fromiter(map(hashes.__getitem__, found), dtype=np.uint64, count=len(found))


def masks(window: int = WINDOW, differ: int | None = None) -> list[list[int]]:
    """Positions that each seed keeps: whichever ``differ`` words are replaced, one seed ignores them all.

    The positions are dealt into ``differ`` + 2 classes; a seed leaves out ``differ`` of the classes.
    """
    differ = window - math.ceil(SIMILARITY * window) if differ is None else differ
    classes = differ + 2
    return [[p for p in range(window) if p % classes not in out] for out in itertools.combinations(range(classes), differ)]


def seed_hashes(tokens: np.ndarray, kept: list[int], window: int) -> np.ndarray:
    """A hash of the kept positions of every window."""
    n = len(tokens) - window + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for p in kept:
        if n > 0:
            out = (out ^ tokens[p:p + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out


@dataclass
class Index:
    """Windows of a block of benchmark items by window length: start of each, item of each, and for each seed the sorted hashes."""

    tokens: np.ndarray
    items: np.ndarray
    groups: list[tuple[int, list[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]]]

    @classmethod
    def of(cls, items: list[tuple[int | None, str]], window: int = WINDOW) -> Index:
        hashes, tokens, owner, starts = _Hashes(), [], [], {}
        at = 0
        for k, (_, text) in enumerate(items):
            t = words(text, hashes)
            if len(t) >= SHORTEST:
                length = min(window, len(t))
                starts.setdefault(length, []).extend(range(at, at + len(t) - length + 1))
                tokens.append(t)
                owner += [k] * len(t)
                at += len(t)
        flat = np.concatenate(tokens) if tokens else np.empty(0, np.uint64)
        groups = []
        for length, places in sorted(starts.items()):
            places = np.array(places, dtype=np.int64)
            seeds = []
            for kept in masks(length):
                h = seed_hashes(flat, kept, length)[places]
                order = np.argsort(h, kind="stable")
                present = np.zeros(1 << _BITS, dtype=bool)
                present[(h >> np.uint64(64 - _BITS)).astype(np.int64)] = True
                seeds.append((kept, h[order], places[order], present))
            groups.append((length, seeds))
        return cls(flat, np.array(owner, dtype=np.int64), groups)

    def overlaps(self, doc: np.ndarray, similarity: float = SIMILARITY, window: int = WINDOW) -> list[tuple[int, int, int]]:
        """(item, first word, end) of the merged verified windows in a document, by item and place."""
        spans: dict[int, list[tuple[int, int]]] = {}
        for length, seeds in self.groups:
            if len(doc) < length:
                continue
            hits = set()
            for kept, sorted_hashes, places, present in seeds:
                h = seed_hashes(doc, kept, length)
                for p in np.nonzero(present[(h >> np.uint64(64 - _BITS)).astype(np.int64)])[0]:
                    lo, hi = np.searchsorted(sorted_hashes, h[p], "left"), np.searchsorted(sorted_hashes, h[p], "right")
                    hits.update((int(p), int(q)) for q in places[lo:hi])
            need = math.ceil(similarity * length)
            for p, q in sorted(hits):
                if int((doc[p:p + length] == self.tokens[q:q + length]).sum()) >= need:
                    own = spans.setdefault(int(self.items[q]), [])
                    if own and p <= own[-1][1]:
                        own[-1] = (own[-1][0], max(own[-1][1], p + length))
                    else:
                        own.append((p, p + length))
        return [(k, a, b) for k in sorted(spans) for a, b in spans[k]]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", *, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents that repeat benchmark passages, with up to a fifth of a window's words replaced.

    Words are ``\\w+`` of the lower-case text. Six fixed masks over 13 words ignore selected positions; the hash of
    the rest is looked up among those of the benchmark's windows, and a hit counts if 11 of the 13 words agree.
    Verified windows of an item that touch are one overlap. The benchmark is searched in blocks of about
    ``block_words`` words, each a scan of the documents, so what is sent to the tasks has a fixed bound.

    Result: a row for each contaminated document, whatever the number of blocks: doc_id, text_key, item_ids, n_words, n_covered (words in
    an overlap), overlaps (item_id, start, end in words). Clean documents have no row. Null and empty texts have no
    words. Repeated rows have a row each; null ids are reported as null. Items under 8 words are no evidence; those of
    8 to 12 are one window, with the same share of agreeing words. Empty tables give no rows.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.size(F.split("text", r"\W+"))), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / block_words))
    parts = []
    for k in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).distinct().orderBy("item_id", "text").collect() if blocks > 1 else items.distinct().orderBy("item_id", "text").collect()
        parts.append(_search(docs, spark.sparkContext.broadcast(([r["item_id"] for r in block], Index.of([tuple(r) for r in block]))), id_col, text_col))
    return parts[0] if blocks == 1 else _merged(parts)


def _merged(parts: list[DataFrame]) -> DataFrame:
    """One row for each contaminated row of the documents, from the results of all blocks.

    Rows of equal doc_id and text have equal results in every block, so they are merged as one and then repeated as often
    as a block has them.
    """
    out = None
    for k, part in enumerate(parts):
        part = part.withColumn("block", F.lit(k))
        out = part if out is None else out.unionAll(part)
    key = ["doc_id", "text_key"]
    single = out.groupBy(*key, "block").agg(F.count("*").alias("times"), F.first("n_words").alias("n_words"), F.first("overlaps").alias("overlaps"))
    whole = single.groupBy(*key).agg(F.max("times").cast("int").alias("times"), F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("overlaps"))).alias("overlaps"))
    spans = F.array_sort(F.transform("overlaps", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    state = F.struct(F.lit(0).alias("reach"), F.lit(0).cast("long").alias("n"))
    step = lambda a, s: F.struct(F.greatest(a["reach"], s["end"]).alias("reach"), (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["reach"], s["start"]))).alias("n"))
    whole = whole.withColumn("n_covered", F.aggregate(spans, state, step, lambda a: a["n"])).withColumn("item_ids", F.array_distinct(F.transform("overlaps", lambda s: s["item_id"])))
    return whole.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*key, "item_ids", "n_words", "n_covered", "overlaps")


def _search(docs: DataFrame, index, id_col: str, text_col: str) -> DataFrame:
    overlap = pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.list_(overlap))
    names = ["doc_id", "text_key", "item_ids", "n_words", "n_covered", "overlaps"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, found_in = index.value
        hashes = _Hashes()
        for part in slices(batches):
            out = []
            for doc_id, text, key in zip(*(c.to_pylist() for c in part.columns), strict=True):
                tokens = words(text, hashes)
                found = sorted(found_in.overlaps(tokens), key=lambda s: (ids[s[0]] is not None, ids[s[0]] or 0, s[1], s[2]))
                if found:
                    covered = np.zeros(len(tokens), dtype=bool)
                    for _, a, b in found:
                        covered[a:b] = True
                    out.append((doc_id, key, list(dict.fromkeys(ids[k] for k, _, _ in found)), len(tokens), int(covered.sum()), [{"item_id": ids[k], "start": a, "end": b} for k, a, b in found]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return keyed(docs, id_col, text_col).mapInArrow(run, "doc_id long, text_key long, item_ids array<long>, n_words long, n_covered long, overlaps array<struct<item_id:long,start:int,end:int>>")
