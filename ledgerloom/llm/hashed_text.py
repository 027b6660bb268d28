"""Vectorised word features of batches of texts, for the classifiers that are trained in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import flat_text, word_hashes, word_spans

SLOT_BITS = 22

_CLASSES = np.zeros(256, np.int64)
_CLASSES[[*range(97, 123)]] = 1
_CLASSES[[*range(65, 91)]] = 2
_CLASSES[[*range(48, 58)]] = 3
_CLASSES[[*b"#*$%&|<>"]] = 4
_CLASSES[[*b"!?"]] = 5
_CLASSES[[*b".,;:'\"()-"]] = 6
_CLASSES[[10]] = 7
_CLASSES[[*b" \t\r\x0b\x0c"]] = 8
_CLASSES[128:] = 9
N_CLASSES = 10
#: ASCII other than letters, which parts words from punctuation and digits.
NO_LETTER = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])
#: Bytes of the prefixes that stand for a word beside itself, so that inflected forms share features.
PREFIXES = (4, 7)


class Vocabulary:
    """Rows for the hash slots of words that at least `least` training texts have; row 0 is for all other words."""

    def __init__(self, slots: np.ndarray):
        self.slots = np.sort(slots)

    @classmethod
    def of(cls, texts: pa.Array, least: int = 3, forms: bool = False) -> Vocabulary:
        slots, docs = word_forms(texts) if forms else words(texts)[:2]
        n, step = np.zeros(1 << SLOT_BITS, np.int32), 500
        bounds = np.searchsorted(docs, np.arange(0, len(texts) + step, step))
        for first, end in zip(bounds, bounds[1:], strict=False):  # some texts at a time, so that memory stays small
            part = slots[first:end].reshape(end - first, -1)
            pairs = np.unique(np.repeat(docs[first:end], part.shape[1]) * (1 << SLOT_BITS) + part.ravel())
            np.add.at(n, pairs & ((1 << SLOT_BITS) - 1), 1)
        return cls(np.flatnonzero(n >= least))

    def __len__(self) -> int:
        return len(self.slots) + 1

    def rows(self, slots: np.ndarray) -> np.ndarray:
        if not hasattr(self, "table"):
            self.table = np.zeros(1 << SLOT_BITS, np.int32)
            self.table[self.slots] = np.arange(1, len(self.slots) + 1)
        return self.table[slots]

    def __getstate__(self) -> dict:
        return {"slots": self.slots}


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Per word, in order, its hash slot and text number; and the flat bytes with their offsets."""
    raw, offsets = flat_text(texts)
    starts, ends, docs = word_spans(raw, offsets)
    return (word_hashes(raw, starts, ends) >> np.uint64(64 - SLOT_BITS)).astype(np.int64), docs, (raw, offsets)


def word_forms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per run of letters, in order, the hash slots of the run and of its prefixes; and its text number."""
    raw, offsets = flat_text(texts)
    starts, ends, docs = word_spans(raw, offsets, NO_LETTER)
    slot = lambda h: (h >> np.uint64(64 - SLOT_BITS)).astype(np.int32)
    prefix = lambda k: word_hashes(raw, starts, np.minimum(ends, starts + k)) * np.uint64(2 * k + 1)
    return np.column_stack([slot(word_hashes(raw, starts, ends)), *(slot(prefix(k)) for k in PREFIXES)]), docs


def statistics(raw: np.ndarray, offsets: np.ndarray, n_words: np.ndarray, n_distinct: np.ndarray) -> np.ndarray:
    """Structure of each text: logarithms of its size and words, word length, shares of kinds of characters, and variety."""
    n = len(offsets) - 1
    kinds = np.bincount(np.repeat(np.arange(n), np.diff(offsets)) * N_CLASSES + _CLASSES[raw], minlength=n * N_CLASSES).reshape(n, N_CLASSES)
    size = np.maximum(1, np.diff(offsets))[:, None]
    w = np.maximum(1, n_words)
    shares = kinds / size
    extra = [np.log1p(n_words), np.log1p(size[:, 0]) - np.log1p(n_words), n_distinct / w, np.log1p(100 * kinds[:, 4] / w), np.log1p(100 * kinds[:, 5] / w), np.log1p(100 * kinds[:, 7] / w), kinds[:, 2] / np.maximum(1, kinds[:, 1] + kinds[:, 2])]
    return np.column_stack([shares, *extra]).astype(np.float64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def platt(raw: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """a, b so that sigmoid(a * raw + b) fits smoothed labels, by Newton steps with a ridge."""
    if len(raw) < 20 or label.min() == label.max():
        return 1.0, 0.0
    pos, neg = label.sum(), len(label) - label.sum()
    t = np.where(label > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.column_stack([raw, np.ones(len(raw))])
    beta = np.array([1.0, 0.0])
    for _ in range(30):
        p = sigmoid(x @ beta)
        g = x.T @ (p - t) + 1e-3 * (beta - [1.0, 0.0])
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        beta = beta - np.clip(step, -2, 2)
    return float(max(beta[0], 0.05)), float(beta[1])
