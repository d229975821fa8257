"""Quality classifier by attention-based multiple-instance learning."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from massloom.llm.common import keyed, slices

#: Words of a passage, whatever the length of the text; passages that a labelled document teaches at most.
PASSAGE, MOST = 64, 64
#: Passages weighed at once.
BLOCK = 2048
#: Hashed trigrams of character classes, and statistics beside them.
SHAPES, STATISTICS = 96, 8
WIDTH = SHAPES + STATISTICS
#: Labelled documents learned from at most, and the sizes of the network.
SAMPLE_DOCS, HIDDEN, GATES = 3000, 32, 16
EPOCHS, BATCH, RATE, DECAY, SEED = 30, 64, 3e-3, 1e-4, 7
THRESHOLD = 0.7
_POWERS = np.cumprod(np.full(32, 0x9E3779B97F4A7C15, dtype=np.uint64))


@functools.cache
def _classes() -> np.ndarray:
    """Class of each code point: white space 0, lower-case 1, upper-case 2, digit 3, other letter 4, ASCII signs apart, the rest 5."""
    out = np.full(0x110000, 5, dtype=np.uint8)
    for c in range(0x110000):
        x = chr(c)
        if x.isspace():
            out[c] = 0
        elif x.islower():
            out[c] = 1
        elif x.isupper():
            out[c] = 2
        elif x.isdigit():
            out[c] = 3
        elif x.isalpha():
            out[c] = 4
        elif c < 128:
            out[c] = 6 + c % 58
    return out


def encode_passages(text: str) -> np.ndarray:
    """Features of each passage, in order: shape trigrams as shares, and eight statistics. No words: one zero row."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kind = _classes()[codes].astype(np.int64)
    inside = kind != 0
    starts = np.nonzero(inside & ~np.concatenate([[False], inside[:-1]]))[0]
    if not len(starts):
        return np.zeros((1, WIDTH), dtype=np.float32)
    n = len(starts)
    passages = -(-n // PASSAGE)
    begins = np.zeros(len(codes), dtype=np.int64)
    begins[starts] = 1
    word_of = np.cumsum(begins) - 1
    passage_of = np.maximum(word_of, 0) // PASSAGE
    padded = np.concatenate([[0], kind, [0]])
    shape = (padded[:-2] * 4096 + padded[1:-1] * 64 + padded[2:]) * 0x9E3779B1 % (1 << 32) >> 12
    counts = np.bincount(passage_of * SHAPES + shape % SHAPES, minlength=passages * SHAPES).reshape(passages, SHAPES)
    chars = np.maximum(counts.sum(1, keepdims=True), 1)
    # words as numbers, for repeats
    ends = np.nonzero(inside & ~np.concatenate([inside[1:], [False]]))[0] + 1
    sizes = ends - starts
    weight = np.where(inside, (codes.astype(np.uint64) + np.uint64(7)) * _POWERS[(np.arange(len(codes)) - starts[np.maximum(word_of, 0)]) % 32], 0)
    word = np.add.reduceat(weight, starts)
    own = np.arange(n) // PASSAGE
    per = np.bincount(own, minlength=passages)

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(own, weights=values.astype(float), minlength=passages) / per

    def share(mask: np.ndarray) -> np.ndarray:
        return np.bincount(passage_of[mask], minlength=passages) / chars[:, 0]

    again = np.concatenate([[False], word[1:] == word[:-1]])
    order = np.lexsort((word, own))
    fresh = np.concatenate([[True], (word[order][1:] != word[order][:-1]) | (own[order][1:] != own[order][:-1])])
    distinct = np.bincount(own[order][fresh], minlength=passages) / per
    last = kind[ends - 1]
    statistics = np.stack([np.log1p(mean(sizes)), np.log1p(mean(sizes * sizes)), mean(again), distinct, mean(last >= 5), share(kind == 2), share(kind == 3), share(kind >= 5)], axis=1)
    return np.concatenate([counts / chars, statistics], axis=1).astype(np.float32)


@dataclass
class Model:
    """Encoder, gated attention and score; ``mean`` and ``scale`` standardise the features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        """x: passages of all documents in a row; first: where each document begins."""
        w = self.weights
        h = np.tanh(x @ w["E"] + w["e"])
        v, u = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        raw = (v * u) @ w["a"]
        owner = np.repeat(np.arange(len(first)), np.diff(np.concatenate([first, [len(x)]])))
        e = np.exp(raw - np.maximum.reduceat(raw, first)[owner])
        attention = e / np.add.reduceat(e, first)[owner]
        z = np.add.reduceat(h * attention[:, None], first)
        score = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["d"][0], -30, 30)))
        return {"h": h, "v": v, "u": u, "owner": owner, "attention": attention, "z": z, "score": score}

    def standard(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.mean) / self.scale, -8, 8).astype(np.float64)

    def score(self, documents: Iterable[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Score and attention of each document; those of up to BLOCK passages together, longer ones block by block."""
        values, weights, held = [], [], []

        def settle() -> None:
            if held:
                first = np.cumsum([0, *[len(d) for d in held[:-1]]])
                f = self.forward(self.standard(np.concatenate(held)), first)
                values.extend(f["score"])
                weights.extend(np.split(f["attention"], first[1:]))
                held.clear()

        for d in documents:
            if sum(map(len, held)) + len(d) > BLOCK:
                settle()
            if len(d) > BLOCK:
                value, weight = self.stream(d)
                values.append(value)
                weights.append(weight)
            else:
                held.append(d)
        settle()
        return np.array(values), weights

    def stream(self, document: np.ndarray, block: int = BLOCK) -> tuple[float, np.ndarray]:
        """Score and attention of one document from a running maximum, sum and weighted encoding over its blocks."""
        w, top, total, z, raws = self.weights, -np.inf, 0.0, np.zeros(HIDDEN), []
        for at in range(0, len(document), block):
            h = np.tanh(self.standard(document[at:at + block]) @ w["E"] + w["e"])
            raw = (np.tanh(h @ w["V"]) / (1 + np.exp(-(h @ w["U"])))) @ w["a"]
            new = max(top, raw.max())
            e, past = np.exp(raw - new), np.exp(top - new)
            top, total, z = new, total * past + e.sum(), z * past + e @ h
            raws.append(raw)
        logit = z / total @ w["c"] + w["d"][0]
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30)))), np.exp(np.concatenate(raws) - top) / total


def fit(documents: list[np.ndarray], labels: np.ndarray) -> Model:
    """Gradient descent (Adam) on the cross-entropy of document labels, both labels weighing the same."""
    rng = np.random.default_rng(SEED)
    every = np.concatenate(documents)
    model = Model(every.mean(0), every.std(0) + 1e-3)
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    w = model.weights = {"E": draw(WIDTH, HIDDEN), "e": np.zeros(HIDDEN), "V": draw(HIDDEN, GATES), "U": draw(HIDDEN, GATES), "a": draw(GATES), "c": draw(HIDDEN), "d": np.zeros(1)}
    m, s = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))
    x_all = [model.standard(d) for d in documents]
    share = np.clip(np.array([(labels == 0).mean(), (labels == 1).mean()]), 1e-9, None)
    weight = 0.5 / share[labels]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x_all))
        for at in range(0, len(order), BATCH):
            batch = order[at:at + BATCH]
            x = np.concatenate([x_all[k] for k in batch])
            first = np.cumsum([0, *[len(x_all[k]) for k in batch[:-1]]])
            f = model.forward(x, first)
            miss = (f["score"] - labels[batch]) * weight[batch] / len(batch)
            g = {"c": f["z"].T @ miss, "d": np.array([miss.sum()])}
            dz = (miss[:, None] * w["c"])[f["owner"]]
            dh = dz * f["attention"][:, None]
            along = (dz * f["h"]).sum(1)
            draw_ = f["attention"] * (along - np.add.reduceat(along * f["attention"], first)[f["owner"]])
            g["a"] = (f["v"] * f["u"]).T @ draw_
            dgate = draw_[:, None] * w["a"]
            dv, du = dgate * f["u"] * (1 - f["v"] ** 2), dgate * f["v"] * f["u"] * (1 - f["u"])
            g["V"], g["U"] = f["h"].T @ dv, f["h"].T @ du
            dh = (dh + dv @ w["V"].T + du @ w["U"].T) * (1 - f["h"] ** 2)
            g["E"], g["e"] = x.T @ dh, dh.sum(0)
            step += 1
            for k in w:
                grad = g[k] + DECAY * w[k]
                m[k] = 0.9 * m[k] + 0.1 * grad
                s[k] = 0.999 * s[k] + 0.001 * grad * grad
                w[k] -= RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def _spaced(features: np.ndarray) -> np.ndarray:
    """MOST passages at even distances of a document to learn from, all of them if there are no more."""
    return features if len(features) <= MOST else features[np.linspace(0, len(features) - 1, MOST).astype(np.int64)]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", *, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """A model from the labelled documents given; None without a label of both kinds.

    Learns from the ``sample_docs`` labelled ids with the smallest hash, half of them of either label as far as there
    are any. Their passages (MOST of a document, at even distances) are all that the driver gets. Null labels and labels other than
    0 and 1 teach nothing; an id with both labels counts as 0; an id on several documents labels each.
    """
    marks = labels.select(F.col(id_col).cast("long").alias("i"), F.col(label_col).cast("int").alias("label")).filter("i IS NOT NULL AND label IN (0, 1)").groupBy("i").agg(F.min("label").alias("label"))
    here = marks.join(docs.select(F.col(id_col).cast("long").alias("i")).distinct(), "i", "left_semi")
    halves = [here.filter(F.col("label") == k).orderBy(F.xxhash64("i"), "i").limit(sample_docs // 2) for k in (0, 1)]
    chosen = F.broadcast(halves[0].union(halves[1]))  # sample_docs rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [_spaced(encode_passages(t)) for t in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([f.tobytes() for f in found], pa.binary())], ["doc_id", "label", "features"])

    rows = keyed(docs, id_col, text_col)
    sample = rows.join(chosen, rows["doc_id"] == chosen["i"]).select("doc_id", "label", "text").mapInArrow(run, "doc_id long, label int, features binary").collect()
    sample.sort(key=lambda r: (r["doc_id"], r["features"]))
    target = np.array([r["label"] for r in sample], dtype=np.int64)
    if len(set(target.tolist())) < 2:
        return None
    return fit([np.frombuffer(r["features"], dtype=np.float32).reshape(-1, WIDTH) for r in sample], target)


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", *, threshold: float = THRESHOLD) -> DataFrame:
    """Quality of every whole text.

    Every passage of 64 words is encoded, gated attention weighs the passages of a document, and the weighted sum is scored.
    Result: doc_id, text_key, score (0 to 1, higher: label 1 likelier), predicted (1 if score >= threshold), n_passages,
    attention (weight of each passage). One row per row of the input; null and empty texts are one passage of zeros;
    without a model every score is 0.5. An empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            found = map(encode_passages, part.column(1).to_pylist())
            if sent.value:
                values, weights = sent.value.score(found)
            else:
                weights = [np.full(len(f), 1 / len(f)) for f in found]
                values = np.full(len(weights), 0.5)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(values), pa.array((values >= threshold).astype(np.int32)), pa.array([len(w) for w in weights], pa.int32()), pa.array([w.tolist() for w in weights], pa.list_(pa.float64()))],
                ["doc_id", "text_key", "score", "predicted", "n_passages", "attention"])

    return keyed(docs, id_col, text_col).mapInArrow(run, "doc_id long, text_key long, score double, predicted int, n_passages int, attention array<double>")
