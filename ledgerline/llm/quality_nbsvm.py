"""Quality classifier: a linear hinge-loss model on n-gram indicators scaled by log-count ratios.

The ratios come from counts over all training documents.  The weights are
fitted by dual coordinate descent on ``SAMPLE`` of them, chosen by the hash
of their ids; the margin is turned into a probability by a logistic curve
fitted on documents of that sample that the descent did not see.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, hash_sample, map_batches

#: Hashed n-gram features.
FEATURES = 1 << 17
#: Labelled documents that the weights are fitted on, about.
SAMPLE = 12_000
#: Penalty of the hinge loss, and passes of the descent.
COST, PASSES = 1.0, 8
#: Added to every count of the log-count ratios.
SMOOTH = 1.0

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _shape(token: str) -> str:
    """What a token looks like: its kind of letters and rough length, or itself if it is punctuation."""
    if token.isalpha():
        kind = "A" if token.isupper() and len(token) > 1 else "Aa" if token[0].isupper() else "a"
        return f"\0{kind}{min(len(token), 12) // 3}"
    return "\0" + ("9" if token.isdigit() else "a9") if token[0].isalnum() else token


class NGrams:
    """Distinct hashed features of a text: one and two tokens, one to three token shapes."""

    def __init__(self) -> None:
        self.find = regex.compile(r"\w+|[^\w\s]+|\n").findall
        self.known: dict[str, tuple[int, int]] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        known = self.known
        if len(known) > 100_000:
            known.clear()
        tokens = self.find(text or "")
        pairs = np.empty((len(tokens), 2), np.uint64)
        for i, t in enumerate(tokens):
            v = known.get(t)
            if v is None:
                v = known[t] = (xxhash.xxh3_64_intdigest(t), xxhash.xxh3_64_intdigest(_shape(t), 1))
            pairs[i] = v
        word, shape = pairs[:, 0], pairs[:, 1]
        grams = [word, shape]
        if len(tokens) > 1:
            grams += [word[:-1] * _ODD + word[1:], shape[:-1] * _ODD + shape[1:]]
        if len(tokens) > 2:
            grams.append((shape[:-2] * _ODD + shape[1:-1]) * _ODD + shape[2:])
        h = np.concatenate(grams) * _ODD
        return np.unique((h >> np.uint64(47)).astype(np.int64))


def ratios(pos: np.ndarray, neg: np.ndarray) -> np.ndarray:
    """Log of the ratio of the classes' smoothed, normalised counts."""
    p, n = pos + SMOOTH, neg + SMOOTH
    return np.log(p / p.sum()) - np.log(n / n.sum())


def scaled(features: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Values of a document's features: the ratios, at length 1."""
    x = ratio[features]
    length = np.sqrt((x * x).sum())
    return x / length if length else x


def descend(docs: list[np.ndarray], y: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model: one dual variable at a time, classes weighted to equal sums."""
    w, bias = np.zeros(FEATURES), 0.0
    values = [scaled(f, ratio) for f in docs]
    top = np.where(y > 0, COST * len(y) / (2 * max(1, (y > 0).sum())), COST * len(y) / (2 * max(1, (y < 0).sum())))
    alpha = np.zeros(len(y))
    rng = np.random.default_rng(1)
    for _ in range(PASSES):
        for i in rng.permutation(len(y)):
            f, x = docs[i], values[i]
            grow = y[i] * (w[f] @ x + bias) - 1
            new = min(max(alpha[i] - grow / (x @ x + 1), 0.0), top[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[f] += step * x
                bias += step
                alpha[i] = new
    return w, bias


def logistic(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (at least 0) and offset of P(label 1) = 1 / (1 + exp(-(slope m + offset))), by Newton steps."""
    a, b = 1.0, 0.0
    t = (y > 0).astype(float)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = np.array([((p - t) * margins).sum() + 1e-2 * a, (p - t).sum() + 1e-2 * b])
        s = p * (1 - p)
        h = np.array([[(s * margins * margins).sum() + 1e-2, (s * margins).sum()], [(s * margins).sum(), s.sum() + 1e-2]])
        d = np.linalg.solve(h, g)
        a, b = a - d[0], b - d[1]
        if np.abs(d).max() < 1e-9:
            break
    return max(a, 0.0), b


def _counts(train: DataFrame) -> DataFrame:
    """(feature, pos, neg): training documents of each class that hold the feature; feature -1 counts the documents."""
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        grams, count = NGrams(), np.zeros((2, FEATURES), np.int64)
        for b in batches:
            for text, label in zip(b["text"], b["_label"].to_pylist()):
                count[label, grams(text.as_py())] += 1
        seen = np.flatnonzero(count.any(axis=0))
        yield {"feature": pa.array(seen), "pos": pa.array(count[1, seen]), "neg": pa.array(count[0, seen])}

    return (map_batches(train.select("text", "_label"), "feature long, pos long, neg long", run)
            .groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))


def fit(train: DataFrame) -> dict:
    """Model of ``train`` (doc_id, text, _label): ratio, weights, bias, slope and offset.

    Only the model (a few megabytes, by FEATURES) reaches the driver; the
    sample is gathered by one task.  Three quarters of it give the weights and
    the rest slope and offset; where either part lacks a class, all of it
    gives both.  Without both classes, every score is the share of label 1.
    """
    scratch = Scratch(train.sparkSession, "quality")
    rows = scratch.keep(train.select("doc_id", "text", "_label"), "train")
    counts = scratch.keep(_counts(rows), "counts")
    pos, neg = np.zeros(FEATURES), np.zeros(FEATURES)
    for r in counts.toArrow().to_batches():
        at = r.column("feature").to_numpy()
        pos[at], neg[at] = r.column("pos").to_numpy(), r.column("neg").to_numpy()
    ratio = ratios(pos, neg)
    chosen = (hash_sample(rows, rows.count(), SAMPLE, ("doc_id", "text")).distinct()
              .repartition(1).sortWithinPartitions("doc_id", "text"))

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        grams, docs, labels = NGrams(), [], []
        for b in batches:
            labels += b["_label"].to_pylist()
            docs += [grams(t.as_py()) for t in b["text"]]
        y = np.where(np.array(labels, int) == 1, 1, -1) if labels else np.zeros(0, int)
        w, bias, slope, offset = np.zeros(FEATURES), 0.0, 0.0, 0.0
        share = (np.count_nonzero(y > 0) + 1) / (len(y) + 2)
        offset = float(np.log(share / (1 - share)))
        if len(set(y.tolist())) == 2:
            seen = np.arange(len(y)) % 4 != 3
            rest = ~seen
            if not all(len(set(y[part].tolist())) == 2 for part in (seen, rest)):
                seen = rest = np.ones(len(y), bool)
            w, bias = descend([d for d, s in zip(docs, seen) if s], y[seen], ratio)
            margins = np.array([w[d] @ scaled(d, ratio) + bias for d, r in zip(docs, rest) if r])
            slope, offset = logistic(margins, y[rest])
        yield {"weights": [w.astype("<f8").tobytes()], "bias": [float(bias)], "slope": [float(slope)], "offset": [float(offset)]}

    model = map_batches(chosen.select("text", "_label"), "weights binary, bias double, slope double, offset double", run).collect()
    scratch.drop(rows, counts)
    if not model:
        return {"ratio": ratio, "weights": np.zeros(FEATURES), "bias": 0.0, "slope": 0.0, "offset": 0.0}
    m = model[0]
    return {"ratio": ratio, "weights": np.frombuffer(m["weights"], "<f8"), "bias": m["bias"], "slope": m["slope"], "offset": m["offset"]}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score): probability of label 1 for every row.

    Null and empty texts have no features and score by the bias alone;
    repeated rows score alike; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        m, grams = shared.value, NGrams()
        for b in batches:
            out = []
            for text in b["text"]:
                f = grams(text.as_py())
                margin = float(m["weights"][f] @ scaled(f, m["ratio"])) + m["bias"]
                out.append(1 / (1 + np.exp(-np.clip(m["slope"] * margin + m["offset"], -30, 30))))
            yield {"doc_id": b["doc_id"], "score": pa.array(out, pa.float64())}

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id long, score double", run)
