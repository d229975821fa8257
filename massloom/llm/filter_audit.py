"""Interaction audit of document filters: a table-driven byte transducer measures each text, and the outcome of every filter order follows from counts of failure sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from massloom.llm.common import slices, text_of, written

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 100, 80, 10, b"#$%&*|"
#: Bytes that one round of the transducer takes in, and words that one hash table holds.
BLOCK, WORDS = 1 << 20, 1 << 18

#: Outputs of a transition: a word begins, a word ends in front of the byte, a capital, a symbol, a code point.
BEGIN, END, CAPITAL, SYMBOL, POINT = 1, 2, 4, 8, 16
#: The two states: between words and inside one.
GAP, INSIDE = 0, 1


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """The state behind each byte, and the outputs of (state, byte) at 256 * state + byte."""
    after, out = np.full(256, INSIDE, dtype=np.uint8), np.zeros(512, dtype=np.uint8)
    after[[32, *range(9, 14)]] = GAP
    for state in (GAP, INSIDE):
        for byte in range(256):
            given = POINT if byte & 0xC0 != 0x80 else 0
            given |= BEGIN if state == GAP and after[byte] == INSIDE else 0
            given |= END if state == INSIDE and after[byte] == GAP else 0
            given |= CAPITAL if 65 <= byte <= 90 else 0
            given |= SYMBOL if byte in SYMBOLS else 0
            out[256 * state + byte] = given
    return after, out


AFTER, OUT = _machine()
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _eight(raw: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as one number, without those beyond ``left``; ``raw`` has eight bytes to spare."""
    words = np.ndarray((len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
    return words[at] & _MASKS[np.minimum(left, 8)]


def _hashes(raw: np.ndarray, doc: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    found = (doc.astype(np.uint64) + np.uint64(1)) * _MIX ^ length.astype(np.uint64)
    rest, offset = np.arange(len(start)), 0
    while len(rest):
        h = (found[rest] ^ _eight(raw, start[rest] + offset, length[rest] - offset)) * _MIX
        found[rest] = h ^ (h >> np.uint64(29))
        offset += 8
        rest = rest[length[rest] > offset]
    return found


def _equal(raw: np.ndarray, doc: np.ndarray, start: np.ndarray, length: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether spans a and b are the same word of the same document, byte by byte."""
    same = (length[a] == length[b]) & (doc[a] == doc[b])
    rest, offset = np.flatnonzero(same), 0
    while len(rest):
        x, y = a[rest], b[rest]
        fits = _eight(raw, start[x] + offset, length[x] - offset) == _eight(raw, start[y] + offset, length[y] - offset)
        same[rest[~fits]] = False
        offset += 8
        rest = rest[fits & (length[x] > offset)]
    return same


def distinct_spans(raw: np.ndarray, doc: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Spans that are the first holders of their word in their document.

    An open-addressing hash table takes all spans in rounds: free places are claimed, each span is compared with the
    holder of its place, and goes on to the next place if the words differ. Many words are taken in by residues of
    their hash, so a table stays small.
    """
    hashes = _hashes(raw, doc, start, length)
    parts, found = 1 + len(start) // WORDS, []
    for residue in range(parts):
        pending = np.arange(len(start)) if parts == 1 else np.flatnonzero((hashes >> np.uint64(40)) % np.uint64(parts) == residue)
        size = 1 << max(4, int(2 * len(pending)).bit_length())
        holder, place = np.full(size, -1), (hashes[pending] & np.uint64(size - 1)).astype(np.int64)
        while len(pending):
            free = holder[place] < 0
            holder[place[free]] = pending[free]
            there = holder[place]
            found.append(pending[there == pending])
            known = (hashes[there] == hashes[pending]) & _equal(raw, doc, start, length, pending, there)
            pending, place = pending[~known], (place[~known] + 1) & (size - 1)
    return np.concatenate(found) if found else np.empty(0, dtype=np.int64)


def measure(texts: pa.Array) -> np.ndarray:
    """words, distinct words, capitals, symbols and code points of each text (one row each)."""
    closed = pc.binary_join_element_wise(texts, pa.scalar(b"", texts.type), pa.scalar(b" ", texts.type)).cast(pa.large_binary())
    offsets = np.frombuffer(closed.buffers()[1], dtype=np.int64, count=len(closed) + 1, offset=8 * closed.offset)
    raw = np.zeros(int(offsets[-1] - offsets[0]) + 8, dtype=np.uint8)
    raw[:-8] = np.frombuffer(closed.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    edges = offsets - offsets[0]
    out = np.zeros((len(closed), 5), dtype=np.int64)
    begins, ends, state = [], [], GAP
    for at in range(0, len(raw) - 8, BLOCK):
        piece = raw[at:min(at + BLOCK, len(raw) - 8)]
        before = np.empty(len(piece), dtype=np.uint16)
        before[0], before[1:] = state, AFTER[piece[:-1]]
        given = OUT[before * 256 + piece]
        state = AFTER[piece[-1]]
        begins.append(np.flatnonzero(given & BEGIN) + at)
        ends.append(np.flatnonzero(given & END) + at)
        lo, hi = np.searchsorted(edges, at, "right") - 1, np.searchsorted(edges, at + len(piece), "left")
        cut = np.clip(edges[lo:hi + 1] - at, 0, len(piece))
        for column, bit in ((2, CAPITAL), (3, SYMBOL), (4, POINT)):
            sums = np.concatenate([[0], np.cumsum(given & bit != 0)])
            out[lo:hi, column] += sums[cut[1:]] - sums[cut[:-1]]
    out[:, 4] -= 1  # the space that closes each text
    if begins:
        start, stop = np.concatenate(begins), np.concatenate(ends)
        doc = np.searchsorted(edges, start, "right") - 1
        out[:, 0] = np.bincount(doc, minlength=len(closed))
        out[:, 1] = np.bincount(doc[distinct_spans(raw, doc, start, stop - start)], minlength=len(closed))
    return out


def fails(measures: np.ndarray) -> np.ndarray:
    """Bits of the filters A to D that the measures fail."""
    words, distinct, capitals, symbols, points = measures.T
    bits = ((words < LEAST_WORDS), (100 * distinct < LEAST_DISTINCT * words), (100 * capitals > MOST_CAPITALS * points), (symbols > 0))
    return sum(b.astype(np.int32) << i for i, b in enumerate(bits))


def _packs(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Texts of about ``BLOCK`` bytes at a time, a longer one alone."""
    sizes = pc.fill_null(pc.binary_length(part.column(2)), 0).to_numpy(zero_copy_only=False)
    at, held = 0, 0
    for i, size in enumerate(sizes):
        if i > at and held + size > BLOCK:
            yield part.slice(at, i - at)
            at, held = i, 0
        held += size
    yield part.slice(at)


def document_facts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """doc_id, part, bits (failed filters A to D), words, distinct_words, capitals, symbols, code_points and digest of
    each whole text, in one pass over its bytes. Null texts are empty, a null part is the empty string."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 4096):
            for pack in _packs(part):
                m = measure(pack.column(2))
                digests = [hashlib.sha256(t.as_buffer()).digest() for t in pack.column(2)]
                yield pa.RecordBatch.from_arrays([pack.column(0), pack.column(1), pa.array(fails(m)), *(pa.array(c) for c in m.T.copy()), pa.array(digests, pa.binary())],
                                                 ["doc_id", "part", "bits", "words", "distinct_words", "capitals", "symbols", "code_points", "digest"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text_of(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, part string, bits int, words long, distinct_words long, capitals long, symbols long, code_points long, digest binary")


def failure_sets(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents of each set of failed filters, with those labelled good and toxic.

    A text fails E if an equal one has a smaller doc_id, counted from each text's smallest id; so copies of one text meet
    as partial minima, and only texts that occur under several ids are joined back.
    """
    facts = written(document_facts(docs).select("doc_id", "part", "bits", "digest"))
    first = facts.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).filter("first_id < last_id").select("digest", "first_id")
    marks = labels.filter("quality = 1 OR toxic = 1").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"), F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"))
    rows = facts.join(first, "digest", "left").join(marks, "doc_id", "left")
    repeat = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)).cast("int")
    count = lambda c: F.sum(F.coalesce(c, F.lit(0))).cast("long").alias(c)
    return rows.groupBy("part", (F.col("bits") + repeat * 16).alias("mask")).agg(F.count("*").alias("n"), count("good"), count("toxic"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter does at each step of all 120 orders, for every part of ``docs`` (its ``lang``).

    Filters and failures: A under 100 words; B distinct words under 80 %; C capitals over 10 % of code points; D a symbol
    of #$%&*|; E equal to a text with a smaller doc_id, whatever its part and whether or not that one was removed. The
    texts are read once; all orders follow from at most 32 counts of failure sets in a part.

    Result: part, filter_order, step (1-5), kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley. A text
    without words passes B and an empty one passes C. Rows without doc_id pass E and have no label. Repeated rows
    count each and do not fail E by each other. Several labels of one doc_id are one: good or toxic if any is.
    Null and empty parts are one. An empty table gives no rows; no labels, zeros.
    """
    sets = failure_sets(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("sets"))  # 32 at most
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    rows = sets.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bit = lambda letter: F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(FILTERS) for x in (c, 1 << i)]), letter)
    earlier = F.aggregate(F.sequence(F.lit(1), F.col("step")), F.lit(0), lambda acc, i: acc + F.when(i < F.col("step"), bit(F.substring(F.col("filter_order"), i, F.lit(1)))).otherwise(0))
    rows = rows.withColumn("own", bit(F.substring(F.col("filter_order"), F.col("step"), F.lit(1)))).withColumn("before", earlier)
    total = lambda value, held: F.aggregate(F.filter("sets", held), F.lit(0).cast("long"), lambda acc, s: acc + value(s))
    fails_own = lambda s: s["mask"].bitwiseAND(F.col("own")) != 0
    fails_before = lambda s: s["mask"].bitwiseAND(F.col("before")) != 0
    removed = lambda s: fails_own(s) & ~fails_before(s)
    n = lambda s: s["n"]
    return rows.select(
        "part", "filter_order", "step",
        total(n, lambda s: ~fails_own(s) & ~fails_before(s)).alias("kept"), total(n, removed).alias("removed"), total(n, lambda s: fails_own(s) & fails_before(s)).alias("redundant"),
        total(n, lambda s: s["mask"] == F.col("own")).alias("unique_fails"), total(lambda s: s["good"], removed).alias("good_lost"), total(lambda s: s["toxic"], removed).alias("toxic_lost"),
        # a filter comes first among the p that a text fails in 120 / p of the orders
        total(lambda s: (s["n"] * 120 / F.bit_count(s["mask"])).cast("long"), fails_own).alias("shapley"))
