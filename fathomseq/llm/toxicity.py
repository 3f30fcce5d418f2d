"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, learned from document labels."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MARKS, U64, Words, arrow_map, mix, spans_hash, text_bytes
from .sampling import fitted, fold, labelled, sampled, sampled_texts

FEATURE_BITS = 18
#: Labelled rows of each class that a model is fitted to, at most.
SAMPLE_PER_CLASS = 1200
#: Besides a word itself, its first bytes of these numbers are features, as stems.
PREFIXES = (4, 5, 6)
_STOPS = np.isin(np.arange(256), [ord(c) for c in ".!?"])


@dataclass
class Sentences:
    """Sentences of many texts: hashed features, where each sentence's begin, its bytes, and where each text's sentences begin."""

    features: np.ndarray
    at: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @staticmethod
    def of(column: pa.Array) -> Sentences:
        """A sentence ends at a line feed or after a run of full stops, exclamation or question marks before a space; wordless ones are left out."""
        raw, at = text_bytes(column)
        stop = np.zeros(len(raw), bool)
        if len(raw):
            stop[1:] = _STOPS[raw[:-1]] & (raw[1:] == 32)
            stop |= raw == 10
        begin = np.unique(np.concatenate([at[:-1][at[1:] > at[:-1]], np.flatnonzero(stop)])).astype(np.int64)
        end = np.append(begin[1:], len(raw))
        words = Words(raw, np.append(begin, len(raw)), MARKS)
        hashes = [words.hash]
        for n in PREFIXES:
            to = np.minimum(words.start + n, words.end)
            hashes.append(mix(spans_hash(words.raw, words.start, to) + U64(n)))
        found = (np.stack(hashes, 1) >> U64(64 - FEATURE_BITS)).astype(np.int64).ravel() if len(words.hash) else np.empty(0, np.int64)
        kept = np.flatnonzero(np.diff(words.first))
        offsets = words.first * len(hashes)
        doc = np.searchsorted(at, begin[kept], side="right") - 1
        first = np.searchsorted(doc, np.arange(len(at)))
        return Sentences(found, np.append(offsets[kept], offsets[-1] if len(offsets) else 0), begin[kept] - at[doc], np.minimum(end[kept], at[doc + 1]) - at[doc], first)


@dataclass
class NoisyOr:
    weights: np.ndarray
    bias: float

    def sentences(self, s: Sentences) -> np.ndarray:
        """The chance that each sentence is toxic."""
        total = np.concatenate([[0.0], np.cumsum(self.weights[s.features])])
        return 1 / (1 + np.exp(-np.clip(total[s.at[1:]] - total[s.at[:-1]] + self.bias, -30, 30)))

    def documents(self, p: np.ndarray, first: np.ndarray) -> np.ndarray:
        """One less the chance that no sentence is; 0 without sentences."""
        quiet = np.concatenate([[0.0], np.cumsum(np.log1p(-np.minimum(p, 1 - 1e-9)))])
        return -np.expm1(np.minimum(quiet[first[1:]] - quiet[first[:-1]], 0.0))


def fit(parts: list[Sentences], labels: np.ndarray, rounds: int = 120, rate: float = 1.0, sparse: float = 0.5, least: int = 3, start: float = -8.0, lift: float = 0.5) -> NoisyOr:
    """Maximises the likelihood of document labels under noisy-or by proximal Adagrad on the whole sample; both classes weigh the same.

    A feature has no weight if it is in fewer than ``least`` documents of the
    sample, or pulls less than ``sparse`` documents would.
    """
    size = 1 << FEATURE_BITS
    if not len(labels) or labels.min() == labels.max():
        return NoisyOr(np.zeros(size), -10.0 if not len(labels) or labels[0] == 0 else 3.0)
    found = np.concatenate([s.features for s in parts]).astype(np.int32)
    sizes = np.concatenate([np.diff(s.at) for s in parts])
    in_doc = np.concatenate([np.diff(s.first) for s in parts])
    parts.clear()
    sentence = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    doc, first = np.repeat(np.arange(len(in_doc), dtype=np.int32), in_doc), np.concatenate([[0], np.cumsum(in_doc)])
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())) / len(labels)
    both = doc[sentence].astype(np.int64)
    both *= size
    both += found
    both.sort()
    held = np.bincount(both[np.append(True, both[1:] != both[:-1])] % size, minlength=size) >= least
    del both
    held = held[found]
    found, sentence = found[held], sentence[held]
    at = np.searchsorted(sentence, np.arange(len(sizes) + 1))
    shrink = sparse * weight.max()
    kinds = np.flatnonzero(np.bincount(found, minlength=size))
    place = np.zeros(size, np.int32)
    place[kinds] = np.arange(len(kinds), dtype=np.int32)
    local = place[found]
    del found, held
    w, b = np.zeros(len(kinds)), start
    seen_w, seen_b = np.full(len(kinds), 1e-10), 1e-10
    for _ in range(rounds):
        total = np.concatenate([[0.0], np.cumsum(w[local])])
        p = 1 / (1 + np.exp(-np.clip(total[at[1:]] - total[at[:-1]] + b, -30, 30)))
        quiet = np.concatenate([[0.0], np.cumsum(np.log1p(-np.minimum(p, 1 - 1e-9)))])
        any_ = -np.expm1(quiet[first[1:]] - quiet[first[:-1]])
        pull = np.where(labels == 1, (1 - any_) / np.maximum(any_, 1e-9), -1.0) * weight
        slope = p * pull[doc]
        g = -np.bincount(local, weights=slope[sentence], minlength=len(kinds))
        gb = -slope.sum()
        seen_w += g * g
        seen_b += gb * gb
        step = rate / np.sqrt(seen_w)
        w -= step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * shrink, 0.0)
        b -= lift * gb / np.sqrt(seen_b)
    full = np.zeros(size)
    full[kinds] = w
    return NoisyOr(full, float(b))


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, per_class: int = SAMPLE_PER_CLASS) -> NoisyOr:
    """Fits to at most ``per_class`` rows of each label outside the fold ``held_out``. Their hashed features meet in one task and only the weights come to the driver."""
    sample = sampled(labelled(labels, "toxic").where(fold(folds) != held_out), per_class)

    def read(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        s = Sentences.of(batch.column("text"))
        rows, ends = [], []
        for a, b in zip(s.first[:-1], s.first[1:], strict=True):
            at = s.at[a : b + 1]
            rows.append(s.features[at[0] : at[-1]].astype(np.int32).tobytes())
            ends.append((at - at[0]).tolist())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary()), pa.array(ends, pa.list_(pa.int64()))], ["doc_id", "label", "found", "ends"])

    def fit_all(got: pa.Table) -> NoisyOr:
        parts = []
        for found, ends in zip(got.column("found"), got.column("ends"), strict=True):
            at = np.array(ends.as_py(), np.int64)
            parts.append(Sentences(np.frombuffer(found.as_py(), np.int32), at, at[:-1], at[1:], np.array([0, len(at) - 1])))
        return fit(parts, got.column("label").to_numpy())

    return fitted(arrow_map(sampled_texts(docs, sample), read, "doc_id long, label int, found binary, ends array<long>"), fit_all)


def score_toxicity(docs: DataFrame, model: NoisyOr, folds: int = 5, held_out: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_sentences, offending) for each row of ``docs``.

    ``offending`` are the sentences scored 0.5 or more, and in a document
    predicted toxic at least its worst one: their byte offsets in the UTF-8
    text and their scores. The whole text is read; null, empty and wordless
    texts have no sentence and score 0. Repeated rows stay, a null doc_id is
    not held out, other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        s = Sentences.of(batch.column("text"))
        p = sent.value.sentences(s)
        whole = sent.value.documents(p, s.first)
        spans: list[list] = [[] for _ in whole]
        doc = np.repeat(np.arange(len(whole)), np.diff(s.first))
        bad = p >= 0.5
        for d in np.flatnonzero((whole >= 0.5) & (np.bincount(doc[bad], minlength=len(whole)) == 0)).tolist():
            bad[s.first[d] + int(np.argmax(p[s.first[d] : s.first[d + 1]]))] = True
        for i in np.flatnonzero(bad).tolist():
            spans[doc[i]].append({"begin": int(s.begin[i]), "end": int(s.end[i]), "score": float(p[i])})
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(whole), pa.array(np.diff(s.first)), pa.array(spans, span)], ["doc_id", "score", "n_sentences", "offending"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = arrow_map(rows, score, "doc_id long, score double, n_sentences long, offending array<struct<begin:long,end:long,score:double>>")
    return scored.select("doc_id", F.coalesce(fold(folds) == held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_sentences", "offending")
