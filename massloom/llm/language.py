"""Language identification by mixture inference over character n-grams."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from massloom.llm.common import keyed, slices

#: Hashed character trigrams.
BUCKETS = 1 << 13
SMOOTHING = 0.5
#: A further language must raise the log-likelihood by this many times log(n-grams): every letter counts in three n-grams.
PENALTY = 4.0
ROUNDS, STEP = 50, 1e-4
#: Code points turned into n-grams at once.
BLOCK = 1 << 18
UNDETERMINED = "und"


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def ngram_counts(text: str) -> np.ndarray:
    """Counts of the hashed trigrams of the lower-case text; each run of other characters is one space. No letters: zeros."""
    codes = np.frombuffer(f" {text} ".lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    codes = np.where(_letters()[codes], codes, 0).astype(np.uint64)
    codes = codes[(codes != 0) | np.concatenate([[True], codes[:-1] != 0])]
    counts = np.zeros(BUCKETS, dtype=np.int64)
    if len(codes) < 3:
        return counts
    for at in range(0, len(codes) - 2, BLOCK):
        c = codes[at:at + BLOCK + 2]
        mixed = (c[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (c[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (c[2:] * np.uint64(0x165667B19E3779F9))
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        counts += np.bincount((mixed >> np.uint64(51)).astype(np.int64), minlength=BUCKETS)
    return counts


def train(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages in order and their n-gram probabilities (language x bucket), from every labelled row given.

    Tasks emit their own sums and Spark adds them up; the driver gets languages x BUCKETS counts, whatever the input.
    Rows without a label or a letter teach nothing.
    """
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part in slices(batches):
            for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                sums[lang] = sums.get(lang, 0) + ngram_counts(text)
        for lang, counts in sums.items():
            at = np.nonzero(counts)[0]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(counts[at])], ["lang", "bucket", "n"])

    table: dict[str, np.ndarray] = {}
    for lang, bucket, n in rows.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n")).collect():
        table.setdefault(lang, np.full(BUCKETS, SMOOTHING))[bucket] += n
    languages = sorted(table)
    return languages, np.array([table[x] / table[x].sum() for x in languages]).reshape(len(languages), BUCKETS)


def _em(likely: np.ndarray, counts: np.ndarray, total: float) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights of the languages (rows of ``likely``) by expectation-maximisation, the log-likelihood and the mixture."""
    weights = np.full(len(likely), 1 / len(likely))
    for _ in range(ROUNDS):
        new = weights * (likely @ (counts / (weights @ likely))) / total
        moved = np.abs(new - weights).max()
        weights = new
        if moved < STEP:
            break
    mixture = weights @ likely
    return weights, float(counts @ np.log(mixture)), mixture


def infer(counts: np.ndarray, probabilities: np.ndarray, penalty: float = PENALTY) -> tuple[list[int], np.ndarray, float, float]:
    """The languages of one text, their proportions, a score and the mean gain over uniform n-grams, in nats.

    Starting from the best single language, the language that helps most is added while the log-likelihood grows
    by more than the penalty. The likelihood is concave in the weights, so its slope towards a language bounds what
    that language can add; languages that cannot pay for themselves are not fitted.
    """
    at = np.nonzero(counts)[0]
    n, likely = counts[at].astype(float), probabilities[:, at]
    total = n.sum()
    single = np.log(likely) @ n
    chosen, value = [int(single.argmax())], float(single.max())
    weights, mixture = np.ones(1), likely[chosen[0]]
    price = penalty * math.log(total + 1)
    while len(chosen) < len(likely):
        slope = likely @ (n / mixture) - total
        slope[chosen] = -math.inf
        tried = [(*_em(likely[[*chosen, int(k)]], n, total), int(k)) for k in np.nonzero(slope > price)[0]]
        if not tried:
            break
        new_weights, new_value, new_mixture, k = max(tried, key=lambda t: t[1])
        if new_value - value <= price:
            break
        chosen, weights, value, mixture = [*chosen, k], new_weights, new_value, new_mixture
    order = np.argsort(-weights, kind="stable")
    chosen, weights = [chosen[k] for k in order], weights[order]
    share = np.exp((single - single.max()) / 3)
    certain = share.max() / share.sum() if len(chosen) == 1 else 1.0
    return chosen, weights, float(min(1.0, weights[0] * certain)), value / total + math.log(BUCKETS)


def identify(docs: DataFrame, languages: list[str], probabilities: np.ndarray, id_col: str = "doc_id", text_col: str = "text", *, penalty: float = PENALTY) -> DataFrame:
    """The languages of every whole text.

    Result: doc_id, text_key, lang_pred (largest proportion; ``und`` for a null text, a text without a letter, or
    when nothing was learned), score (0 to 1: proportion, times the posterior of the language where it stands
    alone; 0 for ``und``), languages and proportions (the chosen set, largest first), gain (mean nats an n-gram
    over uniform n-grams; at 0 or below no learned language explains the text; null for ``und``). One row per row
    of the input. Equal likelihoods go to the language first in the alphabet. An empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out = []
            for text in part.column(1).to_pylist():
                counts = ngram_counts(text)
                if not counts.any() or not languages:
                    out.append((UNDETERMINED, 0.0, [], [], None))
                    continue
                chosen, weights, score, gain = infer(counts, probabilities, penalty)
                out.append((languages[chosen[0]], score, [languages[k] for k in chosen], [float(w) for w in weights], gain))
            kinds = (pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64()), pa.float64())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), *[pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]], ["doc_id", "text_key", "lang_pred", "score", "languages", "proportions", "gain"])

    return keyed(docs, id_col, text_col).mapInArrow(run, "doc_id long, text_key long, lang_pred string, score double, languages array<string>, proportions array<double>, gain double")
