"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The features of a text are its known hash slots (counts scaled to unit length), standardised statistics of its structure and
the document's length as metadata. The score adds to the linear part the interactions of all pairs of features, whose weights
are products of low-rank factors: half of (square of sums minus sum of squares), per factor, so time is linear in the features.

Training runs in numpy on a bounded sample of labelled texts (`sample_rows`), with Adagrad; scores are calibrated on a fifth of
the sample. Labels, language, source and doc_id are no inputs.

Defined results: null and empty texts have statistics only; repeated rows get equal scores; without labels of both kinds every
score is the share of good labels (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_texts, labelled_sample, schema_with, split_rows
from .hashed_text import SLOT_BITS, Vocabulary, platt, sigmoid, statistics, words


class FactorisationMachine:
    """Word features come first, then the statistics; factors has one row per feature."""

    def __init__(self, vocabulary: Vocabulary, rank: int = 6, seed: int = 5):
        self.vocabulary, self.rank, self.seed = vocabulary, rank, seed
        self.a, self.b, self.constant = 1.0, 0.0, None

    def features(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Known words as (text, row, value), and the statistics of each text."""
        slots, docs, (raw, offsets) = words(texts)
        n = len(texts)
        pairs, counts = np.unique(docs * (1 << SLOT_BITS) + slots, return_counts=True)
        doc, row = pairs >> SLOT_BITS, self.vocabulary.rows(pairs & ((1 << SLOT_BITS) - 1))
        dense = statistics(raw, offsets, np.bincount(docs, minlength=n), np.bincount(doc, minlength=n))
        known = row > 0
        doc, row, value = doc[known], row[known], counts[known].astype(float)
        norm = np.sqrt(np.bincount(doc, value**2, minlength=n))
        return doc, row, value / norm[doc] if len(doc) else value, dense

    def _standard(self, dense: np.ndarray, meta: np.ndarray) -> np.ndarray:
        meta = np.log1p(np.where(np.isfinite(meta) & (meta >= 0), meta, np.nan))
        both = np.column_stack([dense, meta])
        return np.clip(np.nan_to_num((both - self.mean) / self.scale), -4, 4) / np.sqrt(both.shape[1])

    def _raw(self, doc: np.ndarray, row: np.ndarray, value: np.ndarray, x: np.ndarray) -> np.ndarray:
        n, known = len(x), len(self.vocabulary)
        linear = self.w0 + np.bincount(doc, self.w[row] * value, minlength=n) + x @ self.w[known:]
        for f in range(self.rank):
            v, u = self.v[row, f] * value, x * self.v[known:, f]
            sums = np.bincount(doc, v, minlength=n) + u.sum(1)
            linear += 0.5 * (sums**2 - np.bincount(doc, v**2, minlength=n) - (u**2).sum(1))
        return linear

    def fit(self, texts: pa.Array, meta: np.ndarray, label: np.ndarray, epochs: int = 15, rate: float = 0.1, batch: int = 32) -> None:
        rng = np.random.default_rng(self.seed)
        doc, row, value, dense = self.features(texts)
        logs = np.log1p(np.where(np.isfinite(meta) & (meta >= 0), meta, np.nan))
        both = np.column_stack([dense, logs])
        with np.errstate(all="ignore"):
            self.mean = np.nan_to_num(np.nanmean(both, 0))
            self.scale = np.nan_to_num(np.nanstd(both, 0)) + 1e-6
        x = self._standard(dense, meta)
        known, total = len(self.vocabulary), len(self.vocabulary) + x.shape[1]
        self.w0, self.w, self.v = 0.0, np.zeros(total), rng.normal(0, 0.05, (total, self.rank))
        gw, gv, g0 = np.full(total, 1e-2), np.full((total, self.rank), 1e-2), 1e-2
        bounds = np.searchsorted(doc, np.arange(len(label) + 1))
        stats = np.arange(known, total)
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(len(label)), max(1, len(label) // batch)):
                err0, rows, moves_w, moves_v = 0.0, [], [], []
                for d in part:
                    at = np.concatenate([row[bounds[d] : bounds[d + 1]], stats])
                    val = np.concatenate([value[bounds[d] : bounds[d + 1]], x[d]])
                    v = self.v[at]
                    s = val @ v
                    z = self.w0 + self.w[at] @ val + 0.5 * (s @ s - ((v * val[:, None]) ** 2).sum())
                    err = sigmoid(z) - label[d]
                    err0 += err
                    rows.append(at)
                    moves_w.append(err * val)
                    moves_v.append(err * (val[:, None] * s - v * val[:, None] ** 2))
                at, back = np.unique(np.concatenate(rows), return_inverse=True)
                mw = np.bincount(back, np.concatenate(moves_w)) + 1e-4 * self.w[at]
                mv = np.zeros((len(at), self.rank))
                np.add.at(mv, back, np.concatenate(moves_v))
                mv += 1e-3 * self.v[at]
                gw[at] += mw**2
                gv[at] += mv**2
                g0 += err0**2
                self.w[at] -= rate * mw / np.sqrt(gw[at])
                self.v[at] -= rate * mv / np.sqrt(gv[at])
                self.w0 -= rate * err0 / np.sqrt(g0)

    def raw(self, texts: pa.Array, meta: np.ndarray) -> np.ndarray:
        doc, row, value, dense = self.features(texts)
        return self._raw(doc, row, value, self._standard(dense, meta))

    def score(self, texts: pa.Array, meta: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return sigmoid(self.a * self.raw(texts, meta) + self.b)


def train(texts: pa.Array, meta: np.ndarray, label: np.ndarray) -> FactorisationMachine:
    if len(label) < 20 or label.min() == label.max():
        model = FactorisationMachine(Vocabulary(np.zeros(0, np.int64)))
        model.constant = float(label.mean()) if len(label) else 0.5
        return model
    check = np.arange(len(label)) % 5 == 4
    model = FactorisationMachine(Vocabulary.of(texts.filter(pa.array(~check))))
    model.fit(texts.filter(pa.array(~check)), meta[~check], label[~check])
    model.a, model.b = platt(model.raw(texts.filter(pa.array(check)), meta[check]), label[check])
    return model


def score(docs: DataFrame, model: FactorisationMachine, metadata: str = "n_chars", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """docs' `keep` columns with score; metadata is a numeric column of the document, its nulls count as average."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the words of the bounded sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_rows(batches, "_text"):
            columns = {c: batch.column(c) for c in keep}
            meta = batch.column("_meta").to_numpy(zero_copy_only=False).astype(float)
            yield pa.RecordBatch.from_pydict(columns | {"score": pa.array(shared.value.score(batch.column("_text"), meta), pa.float64())})

    schema = schema_with(docs, keep, "score double")
    return docs.select(*keep, F.col("text").alias("_text"), F.col(metadata).cast("double").alias("_meta")).mapInArrow(run, schema)


def predict(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, sample_rows: int = 6000, metadata: str = "n_chars", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """A score for every document by a machine fitted to the labelled ones outside the held-out fold: about `sample_rows` of them, and SAMPLE_BYTES of text at most."""
    chosen = labelled_sample(labels.select("doc_id", F.col("quality").alias("y")), F.col("y"), folds, held, sample_rows)
    sample = bounded_texts(docs.select("doc_id", "text", F.col(metadata).cast("double").alias("m")), chosen).collect()
    rows = sorted(((r["doc_id"], r["text"] or "", np.nan if r["m"] is None else r["m"], int(r["y"])) for r in sample), key=lambda r: r[:2])
    model = train(pa.array([r[1] for r in rows], pa.large_string()), np.array([r[2] for r in rows], float), np.array([r[3] for r in rows], float))
    return score(docs, model, metadata, keep)
