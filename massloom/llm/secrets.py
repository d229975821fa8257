"""Secret scans: fixed forms, and strings that a character Markov model finds random. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from massloom.llm.common import keyed, slim, written

#: Fixed forms, as the contract gives them.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
#: A string the Markov models judge, and an ordinary identifier they learn from.
CANDIDATE = r"[A-Za-z0-9+/_=-]{12,}"
IDENTIFIER = r"[A-Za-z_][A-Za-z_-]{7,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
STATES = len(ALPHABET) + 1
#: Nats a transition that make a string random, and the length from which that is enough: a shorter one must gather as much
#: in all over its fewer characters, and hold a letter and a digit.
LEAST_RATIO, FULL_LENGTH = 0.5, 20
BACKOFF = 20


def _spans(text: Column, pattern: str, group: int = 0) -> Column:
    """start, end (code points), value of each match, leftmost and non-overlapping, in one pass.

    What stands between the matches comes from ``split``; both lists give the places. A text without a match
    is settled by the first test.
    """
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    hits, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, F.lit(pattern), -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    steps = F.zip_with(F.arrays_zip(hits.alias("hit"), values.alias("value")), F.transform(gaps, F.char_length), lambda h, g: F.struct(g.alias("gap"), F.char_length(h["hit"]).alias("chars"), h["value"].alias("value")))
    steps = F.filter(steps, lambda s: s["chars"].isNotNull())
    begin = F.struct(F.lit(0).alias("at"), none.alias("found"))

    def step(state: Column, s: Column) -> Column:
        start = state["at"] + s["gap"]
        end = start + s["chars"]
        return F.struct(end.alias("at"), F.concat(state["found"], F.array(F.struct(start.alias("start"), end.alias("end"), s["value"].alias("value")))).alias("found"))

    return F.when(text.rlike(pattern), F.aggregate(steps, begin, step, lambda state: state["found"])).otherwise(none)


def _at_least(spans: Column, chars: int) -> Column:
    return F.filter(spans, lambda s: F.char_length(s["value"]) >= chars)


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, assign, access, hex (spans of the fixed forms) and candidate (strings for the models)."""
    text = F.col("text")
    return keyed(docs, id_col, text_col).select(
        "doc_id", "text_key", _at_least(_spans(text, ASSIGN, 2), 8).alias("assign"), _at_least(_spans(text, ACCESS), 16).alias("access"), _spans(text, HEX).alias("hex"), _spans(text, CANDIDATE).alias("candidate"))


def _transitions(strings: DataFrame, kind: str) -> DataFrame:
    """kind, a, b, n: how often state b follows state a in ``strings`` (value, times)."""
    place = lambda at: F.instr(F.lit(ALPHABET), F.substr(F.col("value"), at, F.lit(1)))
    pairs = F.transform(F.sequence(F.lit(1), F.char_length("value") - 1), lambda k: F.struct(place(k).alias("a"), place(k + 1).alias("b")))
    return strings.filter(F.char_length("value") > 1).select("times", F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.sum("times").alias("n")).select(F.lit(kind).alias("kind"), "a", "b", "n")


def train(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[float]:
    """Log-likelihood ratio of every transition, random strings over ordinary identifiers.

    Random strings are the distinct values of the fixed forms. Ordinary identifiers are the words of all documents, as
    often as they occur; equal words are added up in each task before they are taken apart. The driver gets counts
    of state pairs only (2 x 69 x 69).
    """
    values = F.concat(F.transform("assign", lambda s: s["value"]), F.transform("access", lambda s: s["value"]), F.transform("hex", lambda s: s["value"]))
    secret = found.select(F.explode(values).alias("value")).distinct().withColumn("times", F.lit(1).cast("long"))
    plain = F.regexp_replace("text", f"{ASSIGN}|{ACCESS}", " ")
    words = slim(docs, id_col, text_col).select(F.explode(F.regexp_extract_all(plain, F.lit(IDENTIFIER), F.lit(0))).alias("value"))
    words = words.groupBy("value").agg(F.count("*").alias("times"))
    counts = {k: [[0] * STATES for _ in range(STATES)] for k in ("random", "ordinary")}
    for row in _transitions(secret, "random").union(_transitions(words, "ordinary")).collect():
        counts[row["kind"]][row["a"]][row["b"]] += row["n"]
    random, ordinary = _log_likelihoods(counts["random"]), _log_likelihoods(counts["ordinary"])
    return [r - o for r, o in zip(random, ordinary, strict=True)]


def _log_likelihoods(counts: list[list[int]]) -> list[float]:
    """log P(b after a) by state pair: counts, with BACKOFF pseudo-counts shared out as the states are frequent (add-one)."""
    frequent = [1 + sum(row[b] for row in counts) for b in range(STATES)]
    total = sum(frequent)
    return [math.log((counts[a][b] + BACKOFF * frequent[b] / total) / (sum(counts[a]) + BACKOFF)) for a in range(STATES) for b in range(STATES)]


def _ratio(value: Column, table: Column) -> Column:
    """Mean log-likelihood ratio of the transitions of ``value``."""
    place = lambda at: F.instr(F.lit(ALPHABET), F.substr(value, at, F.lit(1)))
    steps = F.transform(F.sequence(F.lit(1), F.char_length(value) - 1), lambda k: F.get(table, place(k) * STATES + place(k + 1)))
    return F.aggregate(steps, F.lit(0.0), lambda a, x: a + x) / (F.char_length(value) - 1)


def _judged(value: Column) -> Column:
    return (F.char_length(value) >= FULL_LENGTH) | (value.rlike("[A-Za-z]") & value.rlike("[0-9]"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least_ratio: float = LEAST_RATIO) -> DataFrame:
    """Secrets of every text: the fixed forms, and long strings likelier under the model of random strings.

    Two first-order character models are trained, on the values of the fixed forms and on the ordinary identifiers of
    all texts. A string of 20 characters or more that touches no fixed form is added as kind ``random`` when its mean
    log-likelihood ratio reaches ``least_ratio`` nats a transition; one of 12 to 19 when it holds a letter and a
    digit and its mean reaches ``least_ratio`` times 20 over its length.

    Result: doc_id, text_key, spans array<struct<start,kind_no,end,value>> by start and kind, n_assign, n_access, n_hex,
    n_random. One row per row of the input, repeated rows too. Null and empty texts have no spans; a null doc_id
    stays null. Without fixed forms in the table the random model is uniform. An empty table gives no rows.
    """
    found = written(base_spans(docs, id_col, text_col))
    scores = F.array(*[F.lit(x) for x in train(docs, found, id_col, text_col)])
    fixed = F.concat("assign", "access", "hex")
    free = F.filter("candidate", lambda c: ~F.exists(fixed, lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"])))
    added = F.filter(free, lambda c: _judged(c["value"]) & (_ratio(c["value"], scores) >= least_ratio * F.greatest(F.lit(1.0), FULL_LENGTH / F.char_length(c["value"]))))
    numbered = lambda spans, k: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind_no"), s["end"].alias("end"), s["value"].alias("value")))
    rows = found.withColumn("random", F.when(F.size("candidate") > 0, added).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>")))
    every = F.array_sort(F.concat(*[numbered(F.col(k), n) for n, k in enumerate(KINDS)]))
    return rows.select("doc_id", "text_key", every.alias("spans"), *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS])


def written_spans(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end, comma-joined in order."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind_no"]), s["start"], s["end"])), ",")
