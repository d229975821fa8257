"""Personal data: fixed forms, and bootstrapped contextual patterns that find further identifiers."""

from __future__ import annotations

import math
import re
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from massloom.llm.common import keyed, slices, written

KINDS = ("email", "ip", "card", "phone")
#: Fixed forms, as the contract gives them. Repeats that cannot need to give anything back are possessive.
_NAME = string.ascii_letters + string.digits + "._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: An unseen word is shaped as an identifier if it has two digits and five letters or digits at least.
_IDENTIFIER = re.compile(r"[A-Za-z0-9]+(?:[-./_:][A-Za-z0-9]+)*")
#: Distinct seeds that a pattern needs, the confidence that makes it count, rounds of scoring, patterns looked for in one scan.
LEAST_SEEDS, CONFIDENCE, ROUNDS, BLOCK_PATTERNS = 5, 0.8, 3, 200_000
#: Distinct ordinary words of contexts held in a task before they are sent.
FLUSH = 200_000
_MARK = "\x00"
_EDGE = "^"


def _name_start(text: str, low: int, at: int) -> int:
    """Where the run of name characters that ends at ``at`` begins, not before ``low``."""
    while at > low:
        step = max(low, at - 256)
        left = len(text[step:at].rstrip(_NAME))
        if left:
            return step + left
        at = step
    return at


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping; found from each ``@``, so a long run of name characters is read once."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = _name_start(text, end, at)
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            end = domain.end()
        at = text.find("@", max(end, at + 1))
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed forms, in order."""
    out = [(a, 0, b) for a, b in emails(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out)


def _marked(text: str, spans: list[tuple[int, int, int]]) -> tuple[list[str], list[tuple[int, str]]]:
    """The lower-case words, each fixed form one word of its own, and (kind, value) of the forms in order."""
    parts, forms, at = [], [], 0
    for start, kind, end in spans:
        if start >= at:
            parts += [text[at:start].replace(_MARK, " ").lower(), f" {_MARK}{len(forms)} "]
            forms.append((kind, text[start:end].lower()))
            at = end
    parts.append(text[at:].replace(_MARK, " ").lower())
    return "".join(parts).split(), forms


def _contexts(words: list[str], k: int) -> list[tuple[str, str, str]]:
    """The patterns that a word stands in: two words before it, and the words on either side."""
    a, b = (words[k - 2] if k > 1 else _EDGE), (words[k - 1] if k else _EDGE)
    c = words[k + 1] if k + 1 < len(words) else _EDGE
    return [(form, *("#" if w.startswith(_MARK) else w for w in pair)) for form, pair in (("before", (a, b)), ("around", (b, c)))]


_SPAN = pa.struct([("start", pa.int32()), ("kind_no", pa.int32()), ("end", pa.int32())])
_SEED = pa.struct([("form", pa.string()), ("c1", pa.string()), ("c2", pa.string()), ("kind_no", pa.int32()), ("value", pa.string())])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, base (spans of the fixed forms), seeds (their contexts and values)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            bases, seeds = [], []
            for text in part.column(1).to_pylist():
                spans = base_spans(text)
                bases.append([{"start": a, "kind_no": k, "end": b} for a, k, b in spans])
                found = []
                if spans:
                    words, forms = _marked(text, spans)
                    for k, w in enumerate(words):
                        if w.startswith(_MARK):
                            kind, value = forms[int(w[1:])]
                            found += [{"form": f, "c1": x, "c2": y, "kind_no": kind, "value": value} for f, x, y in _contexts(words, k)]
                seeds.append(found)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(bases, pa.list_(_SPAN)), pa.array(seeds, pa.list_(_SEED))], ["doc_id", "text_key", "base", "seeds"])

    return keyed(docs, id_col, text_col).mapInArrow(run, "doc_id long, text_key long, base array<struct<start:int,kind_no:int,end:int>>, seeds array<struct<form:string,c1:string,c2:string,kind_no:int,value:string>>")


def _fillers(docs: DataFrame, patterns: list[tuple[str, str, str]], identifiers: bool) -> DataFrame:
    """What else stands in the given contexts: a row for each identifier with its place, or the distinct other words (column word)."""
    sent = docs.sparkSession.sparkContext.broadcast({f: {p[1:] for p in patterns if p[0] == f} for f in ("before", "around")})
    names = ["form", "c1", "c2", "value", "doc_id", "text_key", "start", "end", "word"]
    kinds = [*[pa.string()] * 4, *[pa.int64()] * 2, pa.int32(), pa.int32(), pa.string()]

    def ordinary(plain: set[tuple[str, str, str, str]]) -> pa.RecordBatch:
        rows = [(*context, None, None, None, None, None, word) for *context, word in plain]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def shaped(word: str) -> re.Match | None:
        m = _IDENTIFIER.search(word) if sum(c.isdigit() for c in word) >= 2 else None
        return m if m and sum(c.isalnum() for c in m.group()) >= 5 and sum(c.isdigit() for c in m.group()) >= 2 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, around = sent.value["before"], sent.value["around"]
        plain: set[tuple[str, str, str, str]] = set()
        for part in slices(batches):
            rows = []
            for doc_id, text, key in zip(*(c.to_pylist() for c in part.columns), strict=True):
                spans = base_spans(text)
                words, _ = _marked(text, spans)
                seen = ["#" if w.startswith(_MARK) else w for w in words]
                padded = [_EDGE, _EDGE, *seen, _EDGE]
                hits = [(k, "before", p) for k, p in enumerate(zip(padded, padded[1:], strict=False)) if p in before and k < len(words)]
                hits += [(k, "around", p) for k, p in enumerate(zip(padded[1:], padded[3:], strict=False)) if p in around]
                wanted = {}
                for k, form, p in hits:
                    if seen[k] == "#":
                        continue
                    if not shaped(words[k]):
                        if not identifiers:
                            plain.add((form, *p, words[k]))
                    elif identifiers:
                        wanted.setdefault(k, []).append((form, *p))
                if wanted:
                    for k, (start, word) in enumerate(_word_places(text, spans)):
                        for context in wanted.get(k, ()):
                            m = shaped(word)
                            rows.append((*context, m.group(), doc_id, key, start + m.start(), start + m.end(), None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
            if len(plain) >= FLUSH:
                yield ordinary(plain)
                plain.clear()
        if plain:
            yield ordinary(plain)

    return docs.select("doc_id", "text", "text_key").mapInArrow(run, "form string, c1 string, c2 string, value string, doc_id long, text_key long, start int, end int, word string")


def _word_places(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, str]]:
    """Place and text of each word that ``_marked`` makes, in order."""
    at = 0

    def plain(low: int, high: int) -> Iterator[tuple[int, str]]:
        for m in re.finditer(r"\S+", text[low:high].replace(_MARK, " ")):
            yield low + m.start(), m.group()

    for start, _, end in spans:
        if start >= at:
            yield from plain(at, start)
            yield start, _MARK
            at = end
    yield from plain(at, len(text))


def _score(seeds: DataFrame, fillers: DataFrame, rounds: int, confidence: float) -> DataFrame:
    """form, c1, c2, kind_no, value of the identifiers that confident patterns vouch for.

    The graph joins patterns (context and kind) with the values in their slot. A pattern's score is the share of
    its distinct slot values that count: its own kind's seeds count 1, other kinds' seeds and ordinary words 0, unseen
    identifiers their score so far. An identifier's score is the chance that not all of its patterns err.
    """
    context = ["form", "c1", "c2"]
    own = seeds.groupBy(*context, "kind_no").agg(F.count("*").alias("good"))
    every = own.groupBy(*context).agg(F.sum("good").alias("seeded"))
    unseen = fillers.filter("value IS NOT NULL").select(*context, F.lower("value").alias("value")).distinct()
    ordinary = fillers.filter("value IS NULL").select(*context, "word").distinct().groupBy(*context).agg(F.count("*").alias("plain"))
    width = unseen.groupBy(*context).agg(F.count("*").alias("open"))
    patterns = own.join(every, context).join(ordinary, context, "left").join(width, context, "left")
    patterns = written(patterns.select(*context, "kind_no", "good", (F.col("seeded") + F.coalesce("plain", F.lit(0)) + F.coalesce("open", F.lit(0))).alias("slots")))
    edges = written(unseen.join(patterns.select(*context, "kind_no"), context))
    scores = patterns.select(*context, "kind_no", (F.col("good") / F.col("slots")).alias("score"))
    for _ in range(rounds):
        vouched = edges.join(scores, [*context, "kind_no"]).groupBy("value", "kind_no").agg((1 - F.exp(F.sum(F.log1p(-F.least("score", F.lit(0.999)))))).alias("belief"))
        gained = edges.join(vouched, ["value", "kind_no"]).groupBy(*context, "kind_no").agg(F.sum("belief").alias("gained"))
        scores = written(patterns.join(gained, [*context, "kind_no"], "left").select(*context, "kind_no", ((F.col("good") + F.coalesce("gained", F.lit(0.0))) / F.col("slots")).alias("score")))
    return edges.join(scores.filter(F.col("score") >= confidence), [*context, "kind_no"]).select(*context, "kind_no", "value")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least_seeds: int = LEAST_SEEDS, confidence: float = CONFIDENCE, rounds: int = ROUNDS, block_patterns: int = BLOCK_PATTERNS) -> DataFrame:
    """Personal data of every text: the fixed forms, and identifiers that stand where the fixed forms stand.

    Seeds are the fixed forms. Their contexts (two words before, or the words on both sides, lower case) with at least
    ``least_seeds`` distinct seeds of a kind are patterns. The documents are scanned for identifiers that stand in
    those contexts, and for the ordinary words of the contexts that hold any; a context without an identifier can add
    none and shares no value with another. Scans take about ``block_patterns`` patterns at a time, so what the driver
    and the tasks hold at once is bounded. Pattern and instance scores are then renewed in turn for ``rounds`` rounds, as joins; identifier-shaped words (five
    letters or digits, two of them digits) in a pattern of at least ``confidence`` are added with the pattern's kind.

    Result: doc_id, text_key, base and spans (array of start, kind_no, end in code points, by start and kind; an added
    span that touches a fixed form or an earlier added one is left out). One row per row of the input. Null and
    empty texts have no spans; a null doc_id keeps its fixed forms and gains none. An empty table gives no rows.
    """
    rows = keyed(docs, id_col, text_col)
    found = written(scan(docs, id_col, text_col))
    seeds = found.select(F.explode("seeds").alias("s")).select("s.*").distinct()
    context = ["form", "c1", "c2"]
    patterns = written(seeds.groupBy(*context, "kind_no").agg(F.count("*").alias("seeds")).filter(F.col("seeds") >= least_seeds).select(*context).distinct())

    def standing(patterns: DataFrame, identifiers: bool) -> DataFrame | None:
        """In blocks of patterns, each block one scan."""
        blocks, out = max(1, math.ceil(patterns.count() / block_patterns)), None
        for k in range(blocks):
            part = patterns.filter(F.pmod(F.xxhash64(*context), F.lit(blocks)) == k).collect()
            if part:
                some = written(_fillers(rows, [tuple(r) for r in part], identifiers))
                out = some if out is None else out.union(some)
        return out

    unseen = standing(patterns, True)
    if unseen is None:
        return found.select("doc_id", "text_key", "base", F.col("base").alias("spans"))
    ordinary = standing(written(unseen.select(*context).distinct()), False)
    if ordinary is None:
        return found.select("doc_id", "text_key", "base", F.col("base").alias("spans"))
    fillers = unseen.union(ordinary)
    trusted = _score(seeds.join(patterns, context), fillers, rounds, confidence)
    placed = fillers.filter("value IS NOT NULL AND doc_id IS NOT NULL").withColumn("value", F.lower("value")).join(trusted, [*context, "value"])
    added = placed.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set(F.struct("start", "kind_no", "end"))).alias("added"))
    return found.join(added, ["doc_id", "text_key"], "left").select("doc_id", "text_key", "base", _with_added(F.col("base"), F.col("added")).alias("spans"))


def _with_added(base: Column, added: Column) -> Column:
    apart = lambda s, t: ~((s["start"] < t["end"]) & (t["start"] < s["end"]))
    free = F.filter(F.coalesce(added, F.array().cast("array<struct<start:int,kind_no:int,end:int>>")), lambda a: F.forall(base, lambda b: apart(a, b)))
    chosen = F.aggregate(free, F.array().cast("array<struct<start:int,kind_no:int,end:int>>"), lambda out, a: F.when(F.forall(out, lambda b: apart(a, b)), F.concat(out, F.array(a))).otherwise(out))
    return F.array_sort(F.concat(base, chosen))
