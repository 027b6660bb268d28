"""Near-duplicates by the Jaccard similarity of word shingles: SimHash, then an exact set-similarity join by an inverted index with count filtering.

Every set has a SimHash fingerprint; sets whose fingerprints are equal or linked by the byte-position index of `simhash` are candidates
before all others, and become links if their whole sets are similar. Sets of similarity 4/5 may differ in more bits than positions can
guarantee. All pairs that are not in one component by then are left to the index of shingles, which loses none:

A set of n shingles that reaches similarity 4/5 with another shares at least t = ceil(4n / 5) of its shingles. So if all shingles are
put in one order, whichever it is, the first n - t + K of both sets have at least K in common (all of t, if that is less). Sets are listed
under these, shared entries are tallied for the pairs of each list, pairs below the guaranteed tally are dropped, and the others are verified by
their whole sets. The order puts shingles last that a sample of the texts has often; that only shortens the lists and decides nothing. The sample grows
with the texts, so that a shingle of long lists is known as frequent whatever their number.

Pairs whose shingles per bucket of the hash space leave too small an overlap are dropped before whole sets are brought together; that bound is
never below the true overlap. Pairs within a component cannot change it, so the candidates by fingerprint and one pair per set are verified first and then only pairs across
the components found. Lists above `LIST_MOST` sets are first paired with their `PIVOTS` least sets only, each such pair with a full tally. Where
the sets of such a list are then not all in one component, the pairs across components are compared within the list, by the bound and then by whole
sets, until they are one or no pair is left. So the components are those of all similar pairs. Whole sets stand in such lists once for every list, so
the lists are taken in portions of a bounded share of all sets, one after another; all of them are taken.

Texts are shingled again for the few sets that are verified, rather than all sets stored: they are larger than the texts.

Defined results: texts are split at ASCII white space and A-Z are folded; a null text counts as empty; texts without words are
equal to each other; texts with fewer words than a shingle have one shingle, the whole sequence.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import discard, split_rows, stored
from .components import components

SEED = 42
LIST_MOST, PIVOTS = 64, 4
#: Shared entries of the index that a pair needs.
K = 4
BUCKETS, BUCKET_MOST = 512, 255
#: Texts sampled for the order: one of so many, but this many at least. Shingles that the order has at most.
SHARE, SAMPLE, ORDERED = 8, 5_000, 300_000
#: Whole sets are brought together in long lists up to this share of the bytes of all sets at a time, but up to so many bytes in any case.
PORTION_SHARE, PORTION_LEAST = 0.25, 32 << 20


def shingles(text: bytes, width: int) -> np.ndarray:
    """The distinct word shingles of a text, each hashed by XXH64, in order."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    parts = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)) if len(words) >= width else [b" ".join(words)]
    return np.unique(np.fromiter(map(xxh64_intdigest, parts, repeat(SEED)), np.uint64))


def _bucket_sizes(x: np.ndarray) -> bytes:
    return np.minimum(np.bincount((x >> np.uint64(55)).astype(np.int64), minlength=BUCKETS), BUCKET_MOST).astype(np.uint8).tobytes()


def similar(shared: np.ndarray | int, na: np.ndarray | int, nb: np.ndarray | int) -> np.ndarray | bool:
    """Whether sets of na and nb shingles of which `shared` are common have similarity 4/5 or more."""
    return 5 * shared >= 4 * (na + nb - shared)


def _sets(docs: DataFrame, width: int, keep: str) -> DataFrame:
    """`keep` and the shingles of each text, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_rows(batches, "text"):
            sets = [shingles(t, width).tobytes() for t in pc.fill_null(batch.column("text").cast(pa.binary()), b"").to_pylist()]
            yield pa.RecordBatch.from_pydict({keep: batch.column(keep), "hashes": pa.array(sets, pa.binary())})

    return docs.select(keep, "text").mapInArrow(run, f"{keep} {docs.schema[keep].dataType.simpleString()}, hashes binary")


def _frequent(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ORDERED shingles at most that the sampled texts have most often, several times at least, in order, with their counts."""
    share = min(1.0, max(1 / SHARE, SAMPLE / max(1, docs.count())))
    chosen = docs.where(F.pmod(F.xxhash64("k", F.lit("order")), F.lit(1 << 20)) <= int(share * (1 << 20))).dropDuplicates(["text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_rows(batches, "text"):
            for t in pc.fill_null(batch.column("text").cast(pa.binary()), b"").to_pylist():
                yield pa.RecordBatch.from_pydict({"h": pa.array(shingles(t, width).view(np.int64))})

    counts = stored(chosen.select("text").mapInArrow(run, "h bigint").groupBy("h").agg(F.count(F.lit(1)).alias("count")).where("count > 1"), "shingle-counts")
    least, known = 0, 0
    for c, shingles_ in sorted(counts.groupBy("count").agg(F.count(F.lit(1))).collect(), reverse=True):  # a row for each count that occurs
        known += shingles_
        if known > ORDERED:
            least = c + 1
            break
    rows = counts.where(F.col("count") >= least).toPandas()
    discard(counts)
    h, n = rows["h"].to_numpy(np.int64).view(np.uint64), rows["count"].to_numpy(np.int64)
    order = np.argsort(h)
    return h[order], n[order]


def _prefix(x: np.ndarray, often: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The shingles under which a set is listed."""
    rank = np.zeros(len(x), np.int64)
    if len(often) and len(x):
        at = np.minimum(np.searchsorted(often, x), len(often) - 1)
        rank = np.where(often[at] == x, count[at], 0)
    return x[np.argsort(rank, kind="stable")][: len(x) - (4 * len(x) + 4) // 5 + K]


def shingled(docs: DataFrame, width: int) -> DataFrame:
    """(k, doc_id, node, n, fp, sizes, prefix): node tells the set of shingles, fp is its fingerprint, sizes counts it by bucket, prefix lists it."""
    shared = docs.sparkSession.sparkContext.broadcast(_frequent(docs, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, count = shared.value
        for batch in split_rows(batches, "text"):
            sets = [shingles(t, width) for t in pc.fill_null(batch.column("text").cast(pa.binary()), b"").to_pylist()]
            node = [int.from_bytes(hashlib.blake2b(x.tobytes(), digest_size=8).digest(), "little", signed=True) for x in sets]
            fp = np.array([simhash.fingerprint_of_hashes(x) for x in sets], np.uint64).view(np.int64)
            prefix = [_prefix(x, often, count) for x in sets]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in prefix])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.uint64), *prefix]).view(np.int64)))
            columns = {"k": batch.column("k"), "doc_id": batch.column("doc_id"), "node": pa.array(node, pa.int64()), "n": pa.array([len(x) for x in sets], pa.int64()), "fp": pa.array(fp)}
            yield pa.RecordBatch.from_pydict(columns | {"sizes": pa.array(map(_bucket_sizes, sets), pa.binary()), "prefix": lists})

    return docs.select("k", "doc_id", "text").mapInArrow(run, "k string, doc_id bigint, node bigint, n bigint, fp bigint, sizes binary, prefix array<bigint>")


def _lists(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """Columns of rows sorted by the first one, cut so that no list of equal values is torn, with the first row and end of each list."""
    held = None
    for batch in chain(batches, [None]):
        new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(columns)] if batch is not None else None
        if new is not None:
            held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
        if held is None or not len(held[0]):
            continue
        cut = np.flatnonzero(held[0][1:] != held[0][:-1]) + 1
        first, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(held[0])]])
        whole = held
        if batch is not None:
            held = [x[first[-1] :] for x in whole]
            first, end = first[:-1], end[:-1]
        yield whole, first, end


def _paired(list_most: int, pivots: int):
    """A function over rows (h, node, n) sorted by h and node that pairs the sets of each list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs (a, b) of each list whose sizes allow the similarity, with their tally c in units of which K are needed; of long lists those with
        the pivots, and rows (node, h) that are `long`."""
        for (h, node, n), first, end in _lists(batches, 3):
            sizes = end - first
            two = first[sizes == 2]
            a, b, member, of = [node[two]], [node[two + 1]], [], []
            na, nb, pivot = [n[two]], [n[two + 1]], [np.zeros(len(two), bool)]
            for i, e in zip(first[sizes > 2].tolist(), end[sizes > 2].tolist(), strict=True):
                least = e - i
                if least > list_most:
                    member.append(node[i:e])
                    of.append(h[i:e])
                    least = pivots
                x, y = np.nonzero(np.arange(least)[:, None] < np.arange(e - i)[None, :])
                for out, v in ((a, node[i + x]), (b, node[i + y]), (na, n[i + x]), (nb, n[i + y]), (pivot, np.full(len(x), least < e - i))):
                    out.append(v)
            a, b, na, nb, pivot = map(np.concatenate, (a, b, na, nb, pivot))
            fit = similar(np.minimum(na, nb), na, nb)
            need = np.minimum(K, (4 * np.minimum(na, nb) + 4) // 5)
            c = np.where(pivot, K, -(-K // np.maximum(need, 1)))[fit]
            low, high = np.minimum(a, b)[fit], np.maximum(a, b)[fit]
            order = np.lexsort((high, low))
            low, high, c = low[order], high[order], c[order]
            start = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])])) if len(low) else np.zeros(0, np.int64)
            tally = np.minimum(np.add.reduceat(c, start), K) if len(start) else c
            none = np.zeros(0, np.int64)
            long_ = np.concatenate([none, *member]), np.concatenate([none, *of])
            yield pa.RecordBatch.from_pydict({"a": pa.array(np.concatenate([low[start], long_[0]])), "b": pa.array(np.concatenate([high[start], long_[1]])),
                                              "c": pa.array(np.concatenate([tally, np.zeros(len(long_[0]), np.int64)]).astype(np.int8)),
                                              "long": pa.array(np.arange(len(start) + len(long_[0])) >= len(start))})

    return run


def _sizes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BUCKETS)


def _possible(x: np.ndarray, y: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Whether counts by bucket allow the similarity; where a count may be cut off, it is always possible."""
    least = np.minimum(x, y)
    return similar(least.sum(axis=-1, dtype=np.int64), na, nb) | (least == BUCKET_MOST).any(axis=-1)


_side = lambda df, s: df.select(*(F.col(c).alias(f"{c}_{s}") for c in df.columns))


def _joined(pairs: DataFrame, df: DataFrame) -> DataFrame:
    """pairs (a, b) with the columns of df (node, ...) for either side."""
    return pairs.select("a", "b").join(_side(df, "a"), F.col("a") == F.col("node_a")).join(_side(df, "b"), F.col("b") == F.col("node_b"))


def bounded(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """The pairs whose counts by bucket allow the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                n = [part.column(f"n_{s}").to_numpy() for s in "ab"]
                yield part.select(["a", "b"]).filter(pa.array(_possible(_sizes(part.column("sizes_a")), _sizes(part.column("sizes_b")), *n)))

    return _joined(pairs, sizes).mapInArrow(run, "a bigint, b bigint")


def _views(column: pa.Array) -> Iterator[np.ndarray]:
    """The sets of a column, without copies."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    for first, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        yield data[first:end].view(np.uint64)


def verified(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """(a, b) of the pairs whose sets, of the table whole (node, hashes), have similarity 4/5 or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(_views(batch.column("hashes_a")), _views(batch.column("hashes_b")), strict=True)
            keep = [bool(similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))) for x, y in sides]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return stored(_joined(pairs, whole).mapInArrow(run, "a bigint, b bigint"), "shingle-links")


def _whole(nodes: DataFrame, docs: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """(node, hashes) of the sets in nodes (_n), shingled from one text of each."""
    of = rows.groupBy("node").agg(F.min("k").alias("_k")).join(nodes.distinct(), F.col("node") == F.col("_n"), "left_semi")
    texts = docs.join(of, F.col("k") == F.col("_k")).select("node", "text").dropDuplicates(["node"])
    return stored(_sets(texts, width, "node"), "shingle-sets")


def _by_fingerprint(sets: DataFrame) -> DataFrame:
    """Pairs (a, b) that connect the sets whose fingerprints are equal or linked, not all pairs of them."""
    distinct = stored(sets.groupBy("fp").agg(F.min("node").alias("rep")), "simhash-distinct")
    equal = sets.select("node", "fp").join(distinct.select(F.col("fp").alias("_fp"), "rep"), F.col("fp") == F.col("_fp")).where("node <> rep")
    pairs = equal.select(F.col("rep").alias("a"), F.col("node").alias("b")).union(simhash.link(distinct).select(F.least("a", "b"), F.greatest("a", "b")))
    out = stored(pairs.distinct(), "simhash-pairs")
    discard(distinct)
    return out


def _across_components(pairs: DataFrame, near: DataFrame) -> DataFrame:
    """The pairs whose sides are not known to be in one component."""
    of = lambda s: near.select(F.col("node").alias(f"_n{s}"), F.col("component").alias(f"_c{s}"))
    both = pairs.join(of("a"), F.col("a") == F.col("_na"), "left").join(of("b"), F.col("b") == F.col("_nb"), "left")
    return both.where(F.coalesce("_ca", "a") != F.coalesce("_cb", "b")).select("a", "b")


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Similar pairs of each list (h, node, component, n, hashes), sorted by size, that join components: at most one for each component but the first.

    Pairs within a component are passed over, also those that a link found before has joined; the others are compared by the bound, then by their whole sets.
    """
    for (_, node, component, n, hashes), first, end in _lists(batches, 5):
        a, b = [], []
        for i, e in zip(first.tolist(), end.tolist(), strict=True):
            sets = [np.frombuffer(h, np.uint64) for h in hashes[i:e]]
            x = np.frombuffer(b"".join(map(_bucket_sizes, sets)), np.uint8).reshape(-1, BUCKETS)
            own, size = np.unique(component[i:e], return_inverse=True)[1], n[i:e]
            last = np.searchsorted(4 * size, 5 * size, side="right")
            for r in range(e - i):
                other = np.flatnonzero(own[r + 1 : last[r]] != own[r]) + r + 1
                for o in other[_possible(x[r], x[other], size[r], size[other])].tolist():
                    if own[o] != own[r] and similar(len(np.intersect1d(sets[r], sets[o], assume_unique=True)), size[r], size[o]):
                        a.append(node[i + r])
                        b.append(node[i + o])
                        own[own == own[o]] = own[r]
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        yield pa.RecordBatch.from_pydict({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})


def _compared(open_: DataFrame, docs: DataFrame, rows: DataFrame, sets: DataFrame, width: int) -> list[DataFrame]:
    """Tables of similar pairs (a, b) that join components within the lists of open_ (h, node, component), a table for each portion of the lists."""
    size = sets.select(F.col("node").alias("_n"), "n")
    weight = 8 * (open_.join(size, F.col("node") == F.col("_n")).agg(F.sum("n")).first()[0] or 0)
    most = max(PORTION_LEAST, int(PORTION_SHARE * 8 * (sets.agg(F.sum("n")).first()[0] or 0)))
    portions, found = max(1, -(-weight // most)), []
    for portion in range(portions):
        own = open_.where(F.pmod(F.xxhash64("h"), F.lit(portions)) == portion)
        whole = _whole(own.select(F.col("node").alias("_n")), docs, rows, width)
        discard(docs)
        known = whole.select(F.col("node").alias("_n"), (F.octet_length("hashes") / 8).cast("bigint").alias("n"), "hashes")
        rest = own.join(known, F.col("node") == F.col("_n")).select("h", "node", "component", "n", "hashes")
        found.append(stored(rest.repartition("h").sortWithinPartitions("h", "n").mapInArrow(_across, "a bigint, b bigint").distinct(), "shingle-across"))
        discard(whole)
    return found


def groups(docs: DataFrame, rows: DataFrame, sets: DataFrame, width: int) -> DataFrame:
    """(node, component) of the sets that are similar to another one; docs has (k, text), rows (k, node), sets (node, n, fp, sizes, prefix)."""
    near_bits = _by_fingerprint(sets)
    listed = sets.select(F.explode("prefix").alias("h"), "node", "n")
    found = stored(listed.repartition("h").sortWithinPartitions("h", "node").mapInArrow(_paired(LIST_MOST, PIVOTS), "a bigint, b bigint, c tinyint, long boolean"), "shingle-lists")
    sizes = sets.select("node", "n", "sizes")
    tallied = stored(found.where("not long").groupBy("a", "b").agg(F.sum("c").alias("c")).where(F.col("c") >= K), "shingle-pairs")
    pairs = stored(bounded(tallied, sizes), "shingle-bounded")
    discard(tallied)
    whole = _whole(near_bits.union(pairs).select(F.explode(F.array("a", "b")).alias("_n")), docs, rows, width)
    first = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    some = verified(near_bits.union(first).distinct(), whole)
    near = components(some)
    links = some.union(verified(_across_components(pairs, near), whole))
    near = components(links)
    discard(whole, near_bits)
    of = near.select(F.col("node").alias("_n"), "component")
    members = found.where("long").select(F.col("b").alias("h"), F.col("a").alias("node")).join(of, F.col("node") == F.col("_n"), "left")
    members = stored(members.select("h", "node", F.coalesce("component", "node").alias("component")), "shingle-members")
    discard(found)
    lists = members.groupBy("h").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.bit_xor(F.xxhash64("node")).alias("mark"), F.count(F.lit(1)).alias("m"))
    lists = lists.where("low <> high").groupBy("mark", "m").agg(F.min("h").alias("_h"))  # lists of the same sets once
    open_ = stored(members.join(lists, F.col("h") == F.col("_h"), "left_semi"), "shingle-open")
    discard(members)
    if open_.isEmpty():
        return near
    for more in _compared(open_, docs, rows, sets, width):
        links = links.union(more)
    discard(open_)
    return components(links)


def one_of_each(docs: DataFrame, width: int = 5) -> DataFrame:
    """One row of each group of similar texts, that of the smallest doc_id; a row without doc_id only where no row of the group has one."""
    key = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.coalesce(F.col("text"), F.lit(""))))
    keyed = docs.select(key.alias("k"), "doc_id", "text")
    made = stored(shingled(keyed, width), "shingles")
    sets = stored(made.select("node", "n", "fp", "sizes", "prefix").dropDuplicates(["node"]), "shingle-prefixes")
    rows = stored(made.select("k", "doc_id", "node"), "shingle-rows")
    discard(made)
    near = groups(keyed, rows, sets, width)
    of = near.select(F.col("node").alias("_n"), "component")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k")).alias("first")
    joined = rows.join(of, F.col("node") == F.col("_n"), "left")
    kept = stored(joined.groupBy(F.coalesce("component", "node")).agg(first).select(F.col("first.k").alias("_kept_key")), "shingle-kept")
    discard(rows, sets, near)
    both = docs.join(kept, key == F.col("_kept_key"))
    return both.dropDuplicates(["_kept_key"]).select(*(F.col(f"`{c}`") for c in docs.columns))
