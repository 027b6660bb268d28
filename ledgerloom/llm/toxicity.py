"""Toxicity by a convolutional text classifier.

Words, as runs of letters, and two prefixes of each are hashed into slots; slots seen in several training texts have an
embedding, all others share a zero one, and a word is the sum of its three. Filters of several widths slide over the embeddings of a text, each filter keeps its greatest response, and a logistic unit combines
them. Every labelled text outside the held-out fold is used: four fifths fit the weights, one fifth the calibration. Texts are dealt into shards of about `SHARD`; in each round every shard goes on from the
common weights by mini-batches in numpy, and the common weights become the mean over shards, that of an embedding over the shards that moved it. Gradients
reach only the words under each filter's greatest response. Words are hashed once for all rounds.

Scores are calibrated on a fifth of the labelled texts, which the shards leave out. Thresholds are calibrated by language on the same fifth: the one with the best
F1 where a language has enough labels, else 0.5. They decide `flagged`; the language is no input of the score.

Defined results: null and empty texts are scored like a text of unknown words; repeated rows get equal scores; without labels of both
kinds every score is the share of toxic labels (0 without any).
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, fold, schema_with, split_rows, stored
from .hashed_text import PREFIXES, SLOT_BITS, Vocabulary, sigmoid, word_forms

WIDTHS = (1, 2, 3)
PAD = max(WIDTHS) - 1
EPOCHS, SHARD = 12, 8_000
#: Places whose responses are found by one product: larger ones start threads that cost more than they save.
PLACES = 512
#: Labels that are broadcast to the documents at a time; all portions are taken.
LABELS_MOST = 1_000_000


def padded(known: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embedding rows of texts with `counts` words, each text followed by PAD unknown ones; start and end of each text's own rows."""
    own = np.maximum(counts, 1).astype(np.int64)
    starts = np.cumsum(own + PAD) - own - PAD
    rows = np.zeros((int((own + PAD).sum()), known.shape[1]), np.int32)
    rows[np.arange(len(known)) + np.repeat(starts - (np.cumsum(counts, dtype=np.int64) - counts), counts)] = known
    return rows, starts, starts + own


class Convolution:
    def __init__(self, vocabulary: Vocabulary, dims: int = 8, filters: int = 8, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.vocabulary, self.filters = vocabulary, filters
        self.emb = rng.normal(0, 0.3, (len(vocabulary), dims))
        self.emb[0] = 0
        self.kernels = {w: rng.normal(0, (w * dims) ** -0.5, (w, dims, filters)) for w in WIDTHS}
        self.bias = {w: np.zeros(filters) for w in WIDTHS}
        self.out, self.base = rng.normal(0, 0.2, filters * len(WIDTHS)), -1.0
        self.a, self.b, self.constant = 1.0, 0.0, None

    def rows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Embedding rows of all texts, each followed by PAD unknown ones; start and end of each text's own rows."""
        slots, docs = word_forms(texts)
        return padded(self.vocabulary.rows(slots), np.bincount(docs, minlength=len(texts)))

    def without_embeddings(self) -> Convolution:
        out = copy.copy(self)
        out.vocabulary = out.emb = None
        return out

    def squares(self) -> dict:
        """What steps are divided by the roots of, before the first step."""
        out: dict = {"emb": np.full_like(self.emb, 1e-2), "out": np.full_like(self.out, 1e-2), "base": 1e-2}
        return out | {w: np.full_like(self.kernels[w], 1e-2) for w in WIDTHS} | {(w, "b"): np.full(self.filters, 1e-2) for w in WIDTHS}

    def fit(self, texts: pa.Array, label: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> None:
        rng, squares, rows = np.random.default_rng(seed), self.squares(), self.rows(texts)
        for _ in range(epochs):
            self.epoch(*rows, label, squares, rng)

    def epoch(self, rows: np.ndarray, starts: np.ndarray, ends: np.ndarray, label: np.ndarray, squares: dict, rng: np.random.Generator, rate: float = 0.15, batch: int = 16) -> None:
        """One pass over texts, given by their rows."""
        if len(label):
            for part in np.array_split(rng.permutation(len(label)), max(1, len(label) // batch)):
                grads = {"out": np.zeros_like(self.out), "base": 0.0} | {w: np.zeros_like(self.kernels[w]) for w in WIDTHS} | {(w, "b"): np.zeros(self.filters) for w in WIDTHS}
                sizes = ends[part] - starts[part]
                first = np.concatenate([[0], np.cumsum(sizes + PAD)[:-1]])
                r = rows[np.arange(int((sizes + PAD).sum())) + np.repeat(starts[part] - first, sizes + PAD)]
                x, best, hidden = self.summed(r), {}, []
                for w in WIDTHS:
                    z = self.responses(x, w)
                    best[w] = np.array([z[:, s : s + n].argmax(1) + s for s, n in zip(first.tolist(), sizes.tolist(), strict=True)])
                    hidden.append(z[np.arange(self.filters), best[w]] + self.bias[w])
                h = np.concatenate(hidden, axis=1)
                act = np.maximum(h, 0)
                err = sigmoid(act @ self.out + self.base) - label[part]
                grads["out"] += err @ act
                grads["base"] += err.sum()
                back = err[:, None] * self.out * (h > 0)
                touched, moves = [], []
                for k, w in enumerate(WIDTHS):
                    g = back[:, k * self.filters : (k + 1) * self.filters]
                    grads[(w, "b")] += g.sum(0)
                    for j in range(w):
                        place = best[w] + j
                        grads[w][j] += np.einsum("dfk,df->kf", x[place], g)
                        touched.append(r[place].ravel())
                        moves.append(np.repeat((g[:, :, None] * self.kernels[w][j].T).reshape(-1, x.shape[1]), r.shape[1], axis=0))
                for key, value in (("out", self.out), *((w, self.kernels[w]) for w in WIDTHS), *(((w, "b"), self.bias[w]) for w in WIDTHS)):
                    squares[key] += grads[key] ** 2
                    value -= rate * grads[key] / np.sqrt(squares[key])
                squares["base"] += grads["base"] ** 2
                self.base -= rate * grads["base"] / np.sqrt(squares["base"])
                at, back = np.unique(np.concatenate(touched), return_inverse=True)
                move = np.zeros((len(at), self.emb.shape[1]))
                np.add.at(move, back, np.concatenate(moves))
                squares["emb"][at] += move**2
                self.emb[at] -= rate * move / np.sqrt(squares["emb"][at])
                self.emb[0] = 0

    def summed(self, rows: np.ndarray) -> np.ndarray:
        x = self.emb[rows[:, 0]]
        for more in rows.T[1:]:
            x += self.emb[more]
        return x

    def responses(self, x: np.ndarray, w: int) -> np.ndarray:
        """Each filter of width w, without its bias, by the place where it starts; x has PAD zero rows at its end."""
        kernels, y = np.concatenate(self.kernels[w], axis=1).T.astype(x.dtype), np.empty((w * self.filters, len(x)), x.dtype)
        for at in range(0, len(x), PLACES):
            y[:, at : at + PLACES] = kernels @ x[at : at + PLACES].T
        for j in range(1, w):
            y[: self.filters, : len(x) - j] += y[j * self.filters : (j + 1) * self.filters, j:]
        return y[: self.filters]

    def raw(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        rows, starts, ends = self.rows(texts)
        x, total, cuts = self.summed(rows), np.full(len(texts), self.base), np.column_stack([starts, ends]).ravel()
        for k, w in enumerate(WIDTHS):
            top = np.maximum.reduceat(self.responses(x, w), cuts, axis=1)[:, ::2].T + self.bias[w]
            total += np.maximum(top, 0) @ self.out[k * self.filters : (k + 1) * self.filters]
        return total

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return sigmoid(self.a * self.raw(texts) + self.b)


def _dense(model: Convolution, squares: dict) -> np.ndarray:
    """All weights but the embeddings, and their squares, as one row."""
    return np.concatenate([np.ravel(x) for x in (model.out, model.base, squares["out"], squares["base"], *(y for w in WIDTHS for y in (model.kernels[w], model.bias[w], squares[w], squares[w, "b"])))])


def _restore(model: Convolution, squares: dict, row: np.ndarray) -> None:
    def take(like: np.ndarray) -> np.ndarray:
        nonlocal row
        part, row = row[: like.size].reshape(like.shape), row[like.size :]
        return part.copy()

    model.out, model.base, squares["out"], squares["base"] = take(model.out), float(take(np.zeros(1))[0]), take(model.out), float(take(np.zeros(1))[0])
    for w in WIDTHS:
        model.kernels[w], model.bias[w], squares[w], squares[w, "b"] = take(model.kernels[w]), take(model.bias[w]), take(model.kernels[w]), take(model.bias[w])


def vocabulary(texts: DataFrame, least: int = 3) -> Vocabulary:
    """The slots of words and prefixes that at least `least` of the texts have; 2**SLOT_BITS bounds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_rows(batches, "text"):
            slots, docs = word_forms(batch.column("text"))
            pairs = np.sort(np.repeat(docs, slots.shape[1]) * (1 << SLOT_BITS) + slots.ravel())
            pairs = pairs[np.diff(pairs, prepend=-1) > 0]
            slot, n = np.unique(pairs & ((1 << SLOT_BITS) - 1), return_counts=True)
            yield pa.RecordBatch.from_pydict({"slot": pa.array(slot, pa.int64()), "n": pa.array(n, pa.int64())})

    counts = texts.select("text").mapInArrow(run, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    return Vocabulary(counts.where(F.col("n") >= least).select("slot").toPandas()["slot"].to_numpy(np.int64))


def _encoded(texts: DataFrame) -> DataFrame:
    """A row for each shard of texts (shard, doc_id, text, y), the texts by doc_id: the slots of its distinct words, the words of its texts as numbers of these, words and y of each text.

    Word forms are found once for all rounds, some texts at a time. Buffers are compressed, so that rows stay a fraction of the text.
    """
    names = ("slots", "words", "counts", "y")

    def distinct(slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pair, at = np.unique(slots[:, 0].astype(np.int64) << SLOT_BITS | slots[:, 1], return_inverse=True)
        key, at = np.unique(at << SLOT_BITS | slots[:, 2], return_inverse=True)
        pair = pair[key >> SLOT_BITS]
        return np.column_stack([pair >> SLOT_BITS, pair & ((1 << SLOT_BITS) - 1), key & ((1 << SLOT_BITS) - 1)]).astype(np.int32), at.astype(np.int32)

    def whole(shard: int, parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        slots, words, counts, y = zip(*parts, strict=True)
        known, at = distinct(np.concatenate(slots))
        before = np.cumsum([0, *map(len, slots)])
        words = [at[b + w] for b, w in zip(before, words, strict=False)]
        packed = {n: pa.array([_packed(x)], pa.binary()) for n, x in zip(names, (known, np.concatenate(words), np.concatenate(counts), np.concatenate(y)), strict=True)}
        return pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64())} | packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts = None, []
        for batch in split_rows(batches, "text"):
            of = batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
            for i, e in zip(cuts, cuts[1:], strict=False):
                if e > i:
                    if parts and of[i] != shard:
                        yield whole(shard, parts)
                        parts = []
                    shard = int(of[i])
                    slots, docs = word_forms(batch.column("text").slice(i, e - i))
                    parts.append((*distinct(slots), np.bincount(docs, minlength=e - i).astype(np.int32), batch.column("y").slice(i, e - i).to_numpy().astype(np.int8)))
        if parts:
            yield whole(shard, parts)

    dealt = texts.repartition("shard").sortWithinPartitions("shard", "doc_id", "text", "y").select("shard", "text", "y")
    return dealt.mapInArrow(run, "shard bigint, slots binary, words binary, counts binary, y binary")


def _packed(x: np.ndarray) -> bytes:
    return len(x.tobytes()).to_bytes(8, "little") + pa.compress(x.tobytes(), codec="zstd", asbytes=True)


def _unpacked(x: bytes, dtype: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(x[8:], int.from_bytes(x[:8], "little"), codec="zstd", asbytes=True), dtype)


def _round(texts: DataFrame, model: Convolution, squares: dict, epoch: int, parts: int) -> None:
    """Every shard's pass over its texts (of `_encoded`) from the same weights, then the mean of the weights."""
    model_dims = model.emb.shape[1]
    shared = texts.sparkSession.sparkContext.broadcast((model, squares))  # bounded by the vocabulary
    blob = pa.schema([("part", pa.int64()), ("shard", pa.int64()), ("k", pa.binary()), ("v", pa.binary())])

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, *packed in (tuple(c[i].as_py() for c in batch.columns) for batch in batches for i in range(batch.num_rows)):
            slots, words, counts, y = (_unpacked(x, t) for x, t in zip(packed, (np.int32, np.int32, np.int32, np.int8), strict=True))
            common, squares = shared.value
            known = common.vocabulary.rows(slots.reshape(-1, len(PREFIXES) + 1))
            used, known = np.unique(np.concatenate([[0], known.ravel()]), return_inverse=True)  # the embeddings of this shard's words, the zero one first
            own, squared = copy.deepcopy((common.without_embeddings(), {x: v for x, v in squares.items() if x != "emb"}))
            own.emb, squared["emb"] = common.emb[used], squares["emb"][used]
            before = squared["emb"].copy()
            own.epoch(*padded(known[1:].reshape(-1, len(PREFIXES) + 1).astype(np.int32)[words], counts), y.astype(float), squared, np.random.default_rng([11, epoch, shard]))
            moved_rows = np.flatnonzero((squared["emb"] != before).any(1))
            k = used[moved_rows]
            v = np.column_stack([own.emb[moved_rows], squared["emb"][moved_rows]]).astype(np.float32)
            rows = [(p, shard, k[k % parts == p].tobytes(), v[k % parts == p].tobytes()) for p in range(parts)] + [(-1, shard, b"", _dense(own, squared).tobytes())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), blob.types, strict=True)], schema=blob)

    def mean(table: pa.Table) -> pa.Table:
        table = table.sort_by("shard")  # sums of floats in one order
        part, values = table.column("part")[0].as_py(), table.column("v").to_pylist()
        if part < 0:
            k, v = b"", np.mean([np.frombuffer(x) for x in values], axis=0)
        else:
            flat = np.concatenate([np.frombuffer(x, np.int64) for x in table.column("k").to_pylist()])
            at, where, n = np.unique(flat, return_inverse=True, return_counts=True)
            v = np.zeros((len(at), 2 * model_dims))
            np.add.at(v, where, np.concatenate([np.frombuffer(x, np.float32) for x in values]).reshape(len(flat), -1))
            k, v = at.tobytes(), (v / n[:, None]).astype(np.float32)
        return pa.Table.from_arrays([pa.array([x], t) for x, t in zip((part, 0, k, v.tobytes()), blob.types, strict=True)], schema=blob)

    names = "part bigint, shard bigint, k binary, v binary"
    for r in texts.mapInArrow(moved, names).groupBy("part").applyInArrow(mean, names).collect():
        if r["part"] < 0:
            _restore(model, squares, np.frombuffer(r["v"]))
        elif r["k"]:
            at, v = np.frombuffer(r["k"], np.int64), np.frombuffer(r["v"], np.float32).reshape(-1, 2 * model_dims)
            model.emb[at], squares["emb"][at] = v[:, :model_dims], v[:, model_dims:]
    shared.destroy()  # with its files
    discard(texts.select("shard"))  # the shuffle files of this round


def _calibrated(checked: DataFrame) -> tuple[float, float]:
    """a, b so that sigmoid(a * raw + b) fits smoothed labels of checked (raw, y), as `platt` does, by Newton steps that are aggregations."""
    n, pos = checked.agg(F.count(F.lit(1)), F.sum("y")).first()
    if n < 20 or pos in (0, n):
        return 1.0, 0.0
    x, t = F.col("raw"), F.when(F.col("y") > 0, (pos + 1) / (pos + 2)).otherwise(1 / (n - pos + 2))
    beta = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), float(beta[0]) * x + float(beta[1])))))
        both = checked.select("raw", (p - t).alias("e"), (p * (1 - p)).alias("w"))
        g0, g1, h00, h01, h11 = both.agg(F.sum(x * F.col("e")), F.sum("e"), F.sum(x * x * F.col("w")), F.sum(x * F.col("w")), F.sum("w")).first()
        step = np.linalg.solve(np.array([[h00, h01], [h01, h11]]) + 1e-3 * np.eye(2), np.array([g0, g1]) + 1e-3 * (beta - [1.0, 0.0]))
        beta = beta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-10:
            break
    return round(float(max(beta[0], 0.05)), 9), round(float(beta[1]), 9)


def _limits(checked: DataFrame, model: Convolution) -> dict[str, float]:
    """For each language of checked (raw, y, lang) with ten labels of either kind the threshold with the best F1."""
    grid = np.round(np.arange(0.1, 0.95, 0.05), 2)
    scored = checked.select("lang", "y", (1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), model.a * F.col("raw") + model.b))))).alias("s"))
    sums = [F.sum(((F.col("s") >= float(t)) & hit).cast("long")) for t in grid for hit in (F.col("y") > 0, F.lit(True))]
    limits = {}
    for lang, n, pos, *found in scored.groupBy("lang").agg(F.count(F.lit(1)), F.sum("y"), *sums).collect():
        if pos >= 10 and n - pos >= 10:
            f1 = np.array([2 * hit / max(1, taken + pos) for hit, taken in zip(found[::2], found[1::2], strict=True)])
            limits[lang] = float(np.median(grid[f1 >= f1.max() - 1e-9]))
    return dict(sorted(limits.items()))


def train(labelled: DataFrame, shard: int = SHARD) -> tuple[Convolution, dict[str, float]]:
    """A classifier from all rows of labelled (doc_id, text, lang, y), and thresholds by language."""
    n, pos = labelled.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    if n < 20 or pos in (0, n):
        model = Convolution(Vocabulary(np.zeros(0, np.int64)))
        model.constant = pos / n if n else 0.0
        return model, {}
    part = lambda what: F.xxhash64("doc_id", F.lit(what))
    check = F.pmod(part("check"), F.lit(5)) == 4
    fitted = labelled.where(~check)
    shards = max(1, round(fitted.count() / shard))
    dealt = fitted.select(F.pmod(part("shard"), F.lit(shards)).alias("shard"), "doc_id", "text", "y")
    texts = stored(_encoded(dealt), "toxicity-texts")
    discard(fitted)  # the shuffle files of the dealing
    model = Convolution(vocabulary(fitted))
    squares = model.squares()
    model.emb, squares["emb"] = model.emb.astype(np.float32), squares["emb"].astype(np.float32)
    for epoch in range(EPOCHS):
        _round(texts, model, squares, epoch, shards)
    raw = score(labelled.where(check), model, ("lang", "y"), raw=True)
    checked = stored(raw.select(F.col("score").alias("raw"), "lang", "y"), "toxicity-check")
    model.a, model.b = _calibrated(checked)
    limits = _limits(checked, model)
    discard(texts, checked)
    return model, limits


def score(docs: DataFrame, model: Convolution, keep: tuple[str, ...] = ("doc_id",), raw: bool = False) -> DataFrame:
    """docs' `keep` columns with score (before calibration if `raw`), from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_rows(batches, "_text"):
            columns = {c: batch.column(c) for c in keep}
            of = shared.value.raw if raw else shared.value.score
            yield pa.RecordBatch.from_pydict(columns | {"score": pa.array(of(batch.column("_text")), pa.float64())})

    schema = schema_with(docs, keep, "score double")
    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, schema)


def predict(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, keep: tuple[str, ...] = ("doc_id",), shard: int = SHARD) -> DataFrame:
    """A score for every document by a classifier of all labelled ones outside the held-out fold, and `flagged` by language."""
    chosen = labels.where(F.col("toxic").isNotNull() & (fold("doc_id", folds) != held)).select("doc_id", F.col("toxic").cast("long").alias("y"))
    text, lang = (F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang"))
    portions = max(1, -(-chosen.count() // LABELS_MOST))
    own = lambda i: chosen.where(F.pmod(F.xxhash64("doc_id", F.lit("portion")), F.lit(portions)) == i)
    tables = [stored(docs.select("doc_id", text, lang).join(F.broadcast(own(i)), "doc_id"), "toxicity-labelled") for i in range(portions)]
    labelled = reduce(DataFrame.unionAll, tables)
    model, limits = train(labelled, shard)
    discard(*tables)
    out = score(docs, model, tuple(dict.fromkeys([*keep, "lang"])))
    limit = F.lit(0.5)
    for lang, t in limits.items():
        limit = F.when(F.coalesce(F.col("lang"), F.lit("")) == lang, F.lit(t)).otherwise(limit)
    return out.withColumn("flagged", F.col("score") >= limit).select(*keep, "score", "flagged")
