"""Quality classifier: naive Bayes log-count ratios scale n-gram indicators for a linear hinge-loss model."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MARKS, U64, Words, arrow_map, mix, pieces, text_bytes, through
from .sampling import fitted, fold, labelled, sampled, sampled_texts

#: Features are hashed to 2 to this power.
FEATURE_BITS = 18
#: Labelled rows of each class that a model is fitted to, at most.
SAMPLE_PER_CLASS = 4000

_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_LETTER = _UPPER | ((np.arange(256) >= 97) & (np.arange(256) <= 122)) | (np.arange(256) >= 128)


def shapes(words: Words, raw: np.ndarray) -> np.ndarray:
    """A hash of each word's look: its case, its marks, and how far back in its text it last stood, up to four words."""

    def count(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(raw) + 1, np.int32)
        np.cumsum(through(flags, raw), dtype=np.int32, out=total[1:])
        return total[words.end] - total[words.start]

    upper, letters, marks = count(_UPPER), count(_LETTER), count(MARKS)
    case = np.where(letters == 0, 3, np.where(upper == 0, 0, np.where((upper == letters) & (letters > 1), 2, 1)))
    last = raw[words.end - 1] if len(words.end) else np.empty(0, np.uint8)
    last = np.where(MARKS[last], last, 0).astype(np.int64)
    doc = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    back = np.zeros(len(doc), np.int64)
    for d in (4, 3, 2, 1):
        same = (words.hash[d:] == words.hash[:-d]) & (doc[d:] == doc[:-d])
        back[d:][same] = d
    return mix((((case * 256 + last) * 4 + np.minimum(marks, 3)) * 5 + back).astype(U64) + U64(77))


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed features of each text, and where each text's begin and end.

    They are the words and word pairs, and the shapes, pairs and triples of shapes.
    """
    raw, at = text_bytes(column)
    words = Words(raw, at)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(words.first))
    found, of = [], []
    for name, tokens, most in ((1, words.hash, 2), (2, shapes(words, raw), 3)):
        for n in range(1, most + 1):
            if len(tokens) < n:
                continue
            h = np.full(len(tokens) - n + 1, U64(name * 8 + n))
            for j in range(n):
                h = mix(h * U64(0xD6E8FEB86659FD93) + tokens[j : len(tokens) - n + 1 + j])
            inside = doc[: len(h)] == doc[n - 1 :]
            found.append((h[inside] >> U64(64 - FEATURE_BITS)).astype(np.int64))
            of.append(doc[: len(h)][inside])
    if not found:
        return np.empty(0, np.int64), np.zeros(len(at), np.int64)
    both = np.unique((np.concatenate(of) << FEATURE_BITS) | np.concatenate(found))
    return both & ((1 << FEATURE_BITS) - 1), np.searchsorted(both >> FEATURE_BITS, np.arange(len(at)))


@dataclass
class NbSvm:
    """A fitted model: the score of a text is the logistic of ``slope`` times its margin."""

    weights: np.ndarray
    bias: float
    slope: float

    def scores(self, found: np.ndarray, at: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(self.weights[found])])
        return 1 / (1 + np.exp(-np.clip(self.slope * (total[at[1:]] - total[at[:-1]] + self.bias), -30, 30)))


def fit(rows: list[np.ndarray], labels: np.ndarray, alpha: float = 1.0, cost: float = 1.0, mixed: float = 0.25, rounds: int = 20, seed: int = 1) -> NbSvm:
    """NB-SVM by dual coordinate descent.

    ``alpha`` smooths the class counts, ``cost`` is the squared hinge loss's
    C, ``mixed`` the share of the weights against their mean size. Each row is
    scaled to unit length. With rows of one class only, every score is that class.
    """
    size = 1 << FEATURE_BITS
    if not len(rows) or labels.min() == labels.max():
        return NbSvm(np.zeros(size), 0.0 if not len(rows) else 4.0 * (2.0 * labels[0] - 1), 1.0)
    counts = []
    for y in (1, 0):
        own = [r for r, label in zip(rows, labels, strict=True) if label == y]
        counts.append(alpha + np.bincount(np.concatenate(own), minlength=size) if own else np.full(size, alpha))
    ratio = np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())
    values = [(x := ratio[r]) / max(np.sqrt(x @ x + 1), 1e-9) for r in rows]
    ends = [1 / max(np.sqrt((x := ratio[r]) @ x + 1), 1e-9) for r in rows]
    w, b = np.zeros(size), 0.0
    y = np.where(labels == 1, 1.0, -1.0)
    # both classes weigh the same
    soft = np.where(labels == 1, (labels == 1).mean(), (labels == 0).mean()) * 2 * 0.5 / cost
    dual, order = np.zeros(len(rows)), np.random.default_rng(seed)
    for _ in range(rounds):
        most = 0.0
        for i in order.permutation(len(rows)):
            r, x = rows[i], values[i]
            gradient = y[i] * (w[r] @ x + b * ends[i]) - 1 + soft[i] * dual[i]
            if dual[i] > 0 or gradient < 0:
                step = max(dual[i] - gradient / (1 + soft[i]), 0.0) - dual[i]
                dual[i] += step
                w[r] += step * y[i] * x
                b += step * y[i] * ends[i]
                most = max(most, abs(gradient))
        if most < 1e-3:
            break
    full = w * ratio
    used = np.abs(w[w != 0]).mean() if (w != 0).any() else 0.0
    full = (1 - mixed) * used * ratio * (w != 0) + mixed * full if mixed < 1 else full
    margins = np.array([full[r].sum() for r in rows])
    return NbSvm(full, *threshold(margins, labels))


def threshold(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Bias and slope of a logistic fitted to margins, with both classes of equal weight."""
    scale = max(margins.std(), 1e-9)
    x, y = (margins - margins.mean()) / scale, labels.astype(float)
    weight = np.where(labels == 1, 0.5 / max((labels == 1).mean(), 1e-9), 0.5 / max((labels == 0).mean(), 1e-9))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(weight * (p - y) * x).mean() + 1e-3 * a, (weight * (p - y)).mean()])
        v = weight * p * (1 - p)
        h = np.array([[(v * x * x).mean() + 1e-3, (v * x).mean()], [(v * x).mean(), v.mean() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    a = max(a, 1e-3)
    return float(b * scale / a - margins.mean()), float(a / scale)


def train(docs: DataFrame, labels: DataFrame, column: str = "quality", folds: int = 3, held_out: int = 1, per_class: int = SAMPLE_PER_CLASS) -> NbSvm:
    """Fits to at most ``per_class`` labelled rows of each class outside the fold ``held_out``.

    The bounded sample's hashed features meet in one task and only the weights
    come to the driver. Labels are read for no other row.
    """
    sample = sampled(labelled(labels, column).where(fold(folds) != held_out), per_class)

    def read(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found, at = features(batch.column("text"))
        rows = [found[a:b].astype(np.int32).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary())], ["doc_id", "label", "found"])

    return fitted(
        arrow_map(sampled_texts(docs, sample), read, "doc_id long, label int, found binary"),
        lambda got: fit([np.frombuffer(x.as_py(), np.int32) for x in got.column("found")], got.column("label").to_numpy()),
    )


def score_quality(docs: DataFrame, model: NbSvm, folds: int = 3, held_out: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``.

    The whole text is read; null is read as empty and scored by the bias.
    ``held_out`` tells whether the row's label was out of reach in training; it
    is false where doc_id is null. Repeated rows stay; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        scores = sent.value.scores(*features(batch.column("text")))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(rows, score, "doc_id long, score double").select("doc_id", F.coalesce(fold(folds) == held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: NbSvm) -> DataFrame:
    """``docs`` without the rows that the model rejects; all columns stay."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        rows = pa.RecordBatch.from_arrays([pa.array(text, pa.large_string(), from_pandas=True)], ["text"])
        return pd.Series(np.concatenate([np.empty(0), *[sent.value.scores(*features(x.column("text"))) for x in pieces(rows)]]))

    return docs.where(score(F.col("text").cast("string")) >= 0.5)
