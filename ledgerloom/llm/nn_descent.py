"""Embedding near-duplicates by NN-descent.

Equal vectors are one class. A first neighbour graph comes from several orders of the classes, each by the signs of random
projections; neighbours in an order are compared in blocks. Rounds of NN-descent refine it: the neighbours of each class, forward
and backward, are compared with one another, and each class keeps its `k` nearest. Vectors are compared by 8-bit copies, and
pairs near the threshold are verified in double precision.

A class whose list is full of links is saturated: it may have more links than its list holds. Lists of saturated classes are enlarged fourfold,
from new orders of these classes alone, until they are no longer full or hold `most_k` links. Links found after that only matter if they join
groups or are counted: groups of at most `tile` classes, and those with a class that is full at `most_k`, are compared in tiles of which only counts leave; in
other groups, whose members have few links each, links are counted from the lists. So the work is quadratic only in groups that are dense.

Recall is audited against an exact search for `audit` sampled classes, for the average class with links and for the average one with at most `k` links, so
that one large group does not hide isolated pairs that are missed. While either is below `goal` another attempt with new orders follows; if
`most_rounds` of them do not reach it, that is an error. The number of orders grows with the logarithm of the number of classes.

Defined results: vectors that are null, zero, of another length than `dims`, or that hold null or non-finite components link with
nothing; equal vectors link with each other; rows that repeat a vec_id are separate vectors with equal results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, stored
from .components import components

BLOCK = 256
TILE = 1024
#: The 8-bit copies tell a cosine to about this.
SLACK = 0.03
EDGE = "a bigint, b bigint, c float"


def _vectors(column: pa.Array, dtype: type, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, dims)


def _small(q: np.ndarray) -> np.ndarray:
    x = q.astype(np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def prepared(vectors: DataFrame, dims: int) -> DataFrame:
    """(vec_id, key, unit, q): the digest, the unit vector in doubles and its 8-bit copy; nulls where there is no direction."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, units, small = [], [], []
            for v in batch.column("embedding").to_pylist():
                x = np.array([np.nan if c is None else c for c in v], float) + 0.0 if v is not None and len(v) == dims else None
                size = float(np.abs(x).max()) if x is not None and np.isfinite(x).all() else 0.0
                if not size:
                    keys.append(None), units.append(None), small.append(None)
                    continue
                keys.append(hashlib.md5(x.tobytes()).digest())
                x = x / size
                x /= np.linalg.norm(x)
                units.append(x.tobytes())
                small.append(np.round(x * (127 / np.abs(x).max())).astype(np.int8).tobytes())
            columns = {"vec_id": batch.column("vec_id")} | {c: pa.array(v, pa.binary()) for c, v in (("key", keys), ("unit", units), ("q", small))}
            yield pa.RecordBatch.from_pydict(columns)

    return vectors.select("vec_id", "embedding").mapInArrow(run, "vec_id bigint, key binary, unit binary, q binary")


def _edges(a: list[np.ndarray], b: list[np.ndarray], c: list[np.ndarray]) -> pa.RecordBatch:
    cat = lambda x, t: pa.array(np.concatenate(x) if x else np.zeros(0, t))
    return pa.RecordBatch.from_arrays([cat(a, np.int64), cat(b, np.int64), cat(c, np.float32)], ["a", "b", "c"])


def _nearest(ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's k nearest among the others, as edges."""
    n = len(ids)
    if n < 2:
        return ids[:0], ids[:0], np.zeros(0, np.float32)
    c = x @ x.T
    np.fill_diagonal(c, -2)
    k = min(k, n - 1)
    at = np.argpartition(-c, k - 1, axis=1)[:, :k] if k < n - 1 else np.argsort(-c, axis=1)[:, :k]
    rows = np.repeat(np.arange(n), k)
    a, b, v = ids[rows], ids[at.ravel()], c[rows, at.ravel()].astype(np.float32)
    keep = (a != b) & (v > -1.5)
    return a[keep], b[keep], v[keep]


def ordered_blocks(classes: DataFrame, orders: int, bits: int, k: int, seed: int, dims: int) -> DataFrame:
    """Edges between neighbours in `orders` orders by the signs of `bits` random projections."""
    planes = np.random.default_rng(seed).normal(size=(orders, bits + 1, dims)).astype(np.float32)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _small(_vectors(batch.column("q"), np.int8, dims))
            for t in range(orders):
                p = x @ planes[t].T
                code = (p[:, 1:] > 0) @ (1 << np.arange(bits)) if bits else np.zeros(len(x), np.int64)
                columns = {"t": pa.array(np.full(len(x), t)), "code": pa.array(code.astype(np.int64)), "at": pa.array(p[:, 0]), "rep": batch.column("rep"), "q": batch.column("q")}
                yield pa.RecordBatch.from_pydict(columns)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, ids, qs = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, dims), np.int8)
        for batch in chain(batches, [None]):
            if batch is not None:
                t = np.concatenate([t, batch.column("t").to_numpy()])
                ids = np.concatenate([ids, batch.column("rep").to_numpy()])
                qs = np.concatenate([qs, _vectors(batch.column("q"), np.int8, dims)])
            a, b, c = [], [], []
            while len(ids) >= BLOCK or (batch is None and len(ids)):
                own = t[:BLOCK] == t[0]
                n = int(own.sum())
                for x, y in zip((a, b, c), _nearest(ids[:n], _small(qs[:n]), k), strict=True):
                    x.append(y)
                t, ids, qs = t[n:], ids[n:], qs[n:]
            yield _edges(a, b, c)

    placed = classes.select("rep", "q").mapInArrow(place, "t bigint, code bigint, at float, rep bigint, q binary")
    return placed.repartitionByRange("t", "code", "at").sortWithinPartitions("t", "code", "at").mapInArrow(compare, EDGE)


def _top(edges: DataFrame, k: int) -> DataFrame:
    """The k nearest of each class; the limit by rank also applies before the shuffle."""
    once = edges.groupBy("a", "b").agg(F.max("c").alias("c"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("c"), "b"))
    return once.withColumn("_r", rank).where(F.col("_r") <= k).drop("_r")


def descend(graph: DataFrame, classes: DataFrame, k: int, dims: int) -> DataFrame:
    """The graph after one round: neighbours of each class, forward and backward, are compared with one another."""
    both = graph.union(graph.select(F.col("b").alias("a"), F.col("a").alias("b"), "c"))
    members = _top(both, 2 * k).select(F.col("a").alias("p"), F.col("b").alias("m"))
    rows = members.join(classes.select("rep", "q"), F.col("m") == F.col("rep")).select("p", "rep", "q")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, dims), np.int8))
        for batch in chain(batches, [None]):
            if batch is not None:
                new = (batch.column("p").to_numpy(), batch.column("rep").to_numpy(), _vectors(batch.column("q"), np.int8, dims))
                held = tuple(np.concatenate([x, y]) for x, y in zip(held, new, strict=True))
            p, ids, qs = held
            if not len(p):
                continue
            cut = np.flatnonzero(p[1:] != p[:-1]) + 1
            first, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(p)]])
            if batch is not None:
                held = tuple(x[first[-1] :] for x in held)
                first, end = first[:-1], end[:-1]
            a, b, c = [], [], []
            x = _small(qs)
            for s, e in zip(first.tolist(), end.tolist(), strict=True):
                for out, y in zip((a, b, c), _nearest(ids[s:e], x[s:e], 3), strict=True):
                    out.append(y)
            yield _edges(a, b, c)

    found = rows.repartition("p").sortWithinPartitions("p").mapInArrow(compare, EDGE)
    return _top(graph.union(found), k)


def _bits(classes: DataFrame) -> int:
    """Signs that split the classes into runs of about a block."""
    return max(0, int(np.ceil(np.log2(max(1, classes.count() / BLOCK)))))


def enlarged(graph: DataFrame, classes: DataFrame, k: int, most_k: int, orders: int, threshold: float, seed: int, dims: int) -> tuple[DataFrame, DataFrame]:
    """The graph with longer lists for classes whose lists are full of links, and the classes (a) whose lists are full at most_k."""
    while True:
        full = stored(graph.where(F.col("c") >= threshold).groupBy("a").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= k).select("a"), "saturated")
        if k >= most_k or full.isEmpty():
            return graph, full
        k = min(4 * k, most_k)
        own = classes.join(full, F.col("rep") == F.col("a"), "left_semi")
        wider = ordered_blocks(own, orders, _bits(own), k, seed + k, dims)
        graph = stored(_top(graph.union(wider), k), "graph")


def verified(edges: DataFrame, classes: DataFrame, threshold: float, dims: int) -> DataFrame:
    """(a, b) of the edges whose cosine in double precision reaches the threshold."""
    pairs = edges.where(F.col("c") >= threshold - SLACK).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    side = lambda n: classes.select(F.col("rep").alias(f"r{n}"), F.col("unit").alias(f"u{n}"))
    rows = pairs.join(side("a"), F.col("a") == F.col("ra")).join(side("b"), F.col("b") == F.col("rb")).select("a", "b", "ua", "ub")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = np.einsum("ij,ij->i", _vectors(batch.column("ua"), np.float64, dims), _vectors(batch.column("ub"), np.float64, dims))
            yield batch.select(["a", "b"]).filter(pa.array(c >= threshold))

    return rows.mapInArrow(run, "a bigint, b bigint")


def listed(links: DataFrame, groups: DataFrame, classes: DataFrame) -> DataFrame:
    """(rep, links): vectors of other classes that each class of a group links with, from the links found."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    sums = both.join(groups.select("node"), F.col("a") == F.col("node"), "left_semi").join(classes.select("rep", "n"), F.col("b") == F.col("rep"))
    return sums.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links"))


def counted(groups: DataFrame, classes: DataFrame, threshold: float, dims: int, tile_rows: int = TILE) -> DataFrame:
    """(rep, links): vectors of other classes that each class of a group links with, by tiles of the group."""
    sizes = groups.groupBy(F.col("component").alias("_g")).agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("tiles"))
    rows = groups.join(sizes, F.col("component") == F.col("_g")).join(classes.select("rep", "n", "unit"), F.col("node") == F.col("rep"))
    tile = F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int")
    rows = rows.select("component", "rep", "n", "unit", tile.alias("t"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("u"))
    rows = rows.select("component", F.least("t", "u").alias("i"), F.greatest("t", "u").alias("j"), "t", "rep", "n", "unit")

    def solve(i: int, j: int, rows: list[tuple]) -> tuple[list[int], list[int]]:
        t = np.array([r[0] for r in rows])
        n = np.array([r[2] for r in rows])
        x = np.frombuffer(b"".join(r[3] for r in rows), np.float64).reshape(-1, dims)
        link = x @ x.T >= threshold
        if i == j:
            np.fill_diagonal(link, False)
        else:
            link &= t[:, None] != t[None, :]
        return [r[1] for r in rows], (link @ n).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = None, []
        for batch in chain(batches, [None]):
            reps, links = [], []
            for row in zip(*(batch.column(c).to_pylist() for c in range(7)), strict=True) if batch is not None else [((None,) * 7)]:
                if row[:3] != held:
                    if rows:
                        r, n = solve(held[1], held[2], rows)
                        reps += r
                        links += n
                    held, rows = row[:3], []
                if row[0] is not None:
                    rows.append(row[3:])
            yield pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(links, pa.int64())], ["rep", "links"])

    tiled = rows.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j").mapInArrow(run, "rep bigint, links bigint")
    return tiled.groupBy("rep").agg(F.sum("links").alias("links"))


def _audited(counts: DataFrame, classes: DataFrame, threshold: float, audit: int, few: int, dims: int) -> float:
    """The lesser of the average shares of links, found by exact search for about `audit` sampled classes, that counts has: of all classes with links, and of those with few."""
    total = classes.count()
    chosen = F.pmod(F.xxhash64("rep", F.lit("audit")), F.lit(1 << 20)) < max(1, int((1 << 20) * min(1.0, audit / max(1, total))))
    sample = classes.where(chosen).select("rep", "unit").limit(4 * audit).collect()
    if not sample:
        return 1.0
    ids = np.array([r["rep"] for r in sample])
    shared = classes.sparkSession.sparkContext.broadcast((ids, np.frombuffer(b"".join(r["unit"] for r in sample), np.float64).reshape(-1, dims)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, x = shared.value
        sums = np.zeros(len(own), np.int64)
        for batch in batches:
            link = x @ _vectors(batch.column("unit"), np.float64, dims).T >= threshold
            link &= own[:, None] != batch.column("rep").to_numpy()[None, :]
            sums += link @ batch.column("n").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(sums)], ["rep", "links"])

    true = classes.select("rep", "n", "unit").mapInArrow(run, "rep bigint, links bigint").groupBy("rep").agg(F.sum("links").alias("sought")).where("sought > 0")
    share = F.least(F.lit(1.0), F.coalesce("links", F.lit(0)) / F.col("sought"))
    row = true.join(counts, "rep", "left").agg(F.avg(share).alias("all"), F.avg(F.when(F.col("sought") <= few, share)).alias("few")).first()
    return min(1.0 if row[c] is None else row[c] for c in ("all", "few"))


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, dims: int = 64, k: int = 10, orders: int = 8, rounds: int = 2, audit: int = 1000,
                    goal: float = 0.99, most_rounds: int = 6, most_k: int = 160, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of vectors (vec_id, embedding)."""
    rows = stored(prepared(vectors, dims), "vectors")
    classes = stored(rows.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.min("unit").alias("unit"), F.min("q").alias("q")), "vector-classes")
    bits = _bits(classes)
    orders += bits
    graph = found = None
    for attempt in range(most_rounds):
        first = stored(ordered_blocks(classes, orders, bits, k, 17 + 1000 * attempt, dims), "block-edges")
        graph = stored(_top(first if graph is None else graph.union(first), k), "graph")
        near = first.where(F.col("c") >= threshold - SLACK)
        found = near if found is None else found.union(near)
        for _ in range(rounds):
            before, graph = graph, stored(descend(graph, classes, k, dims), "graph")
            discard(before)
        wide, full = enlarged(graph, classes, k, most_k, orders, threshold, 17 + 1000 * attempt, dims)
        found = stored(found.union(wide.where(F.col("c") >= threshold - SLACK)), "near-edges")
        discard(first)
        links = stored(verified(found, classes, threshold, dims), "links")
        groups = stored(components(links), "groups")
        dense = groups.join(full, F.col("node") == F.col("a"), "left_semi").select("component").distinct().withColumn("dense", F.lit(True))
        sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("_size"))
        kinds = sizes.join(dense, "component", "left").select("component", ((F.col("_size") <= tile) | F.col("dense").isNotNull()).alias("tiled"))
        groups = stored(groups.join(kinds, "component"), "groups")
        tiled, others = groups.where("tiled"), groups.where("not tiled")
        counts = stored(counted(tiled, classes, threshold, dims, tile).union(listed(links, others, classes)), "link-counts")
        recall = _audited(counts, classes, threshold, audit, k, dims)
        if recall >= goal:
            break
    else:
        raise ArithmeticError(f"recall is {recall:.4f} after {most_rounds} attempts, below {goal}")
    by_class = classes.join(counts.withColumnRenamed("rep", "_r"), F.col("rep") == F.col("_r"), "left").join(groups, F.col("rep") == F.col("node"), "left")
    by_class = by_class.select(F.col("key").alias("_key"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("_links"), F.coalesce("component", "rep").alias("_component"))
    out = rows.select("vec_id", "key").join(by_class, F.col("key") == F.col("_key"), "left")
    out = out.select("vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("_component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
