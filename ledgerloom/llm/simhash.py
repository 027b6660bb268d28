"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint has 64 bits, 8 bytes. Two fingerprints that differ in at most 3 bits share at least 8 - 3 = 5 bytes at equal
positions. The inverted index must not list pairs that share only one byte, for there the lists hold a 256th of everything.
So it is keyed by three bytes at once: of 5 shared positions, 3 fall into one half of the fingerprint, hence each fingerprint
is listed under its 8 triples of positions within a half (24-bit keys), and every pair with the guaranteed matches meets in at
least one list. Within a list the shared positional bytes of each pair are tallied, pairs below 5 are dropped, and the others
are verified by their differing bits.

Equal fingerprints are one entry of the index. Lists above `LIST_MOST` entries are split: each entry is listed anew under the
10 pairs of further positions (40-bit keys), in which again every sought pair meets. Such a list has at most 2**24 distinct
fingerprints; large ones are searched by flipping up to 3 of their free bits, not by comparing all pairs. A list yields a link
from each entry to the least entry of its part of the list, never all pairs.

Defined results: a null text counts as empty; texts without words have fingerprint 0 and are linked like any other; texts with
fewer words than a shingle have one shingle, the whole sequence; repeated rows share their component; a row without doc_id
gets the component of its fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import split_rows, stored
from .components import components

BYTES, BITS = 8, 3
MATCHES = BYTES - BITS
SEED = 42
#: Words that are hashed in one go.
BLOCK_WORDS = 50_000
LIST_MOST = 512


def _mask(positions: tuple[int, ...]) -> int:
    return sum(0xFF << (8 * p) for p in positions)


#: The positions of each list: three of a half, and for split lists those three with two more.
TRIPLES = [t for half in (range(4), range(4, 8)) for t in combinations(half, (MATCHES + 1) // 2)]
SPLIT = [[tuple(sorted((*t, *more))) for more in combinations([p for p in range(BYTES) if p not in t], MATCHES - len(t))] for t in TRIPLES]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: bytes, width: int = 3) -> int:
    """The 64-bit SimHash of a text's word shingles, each hashed by XXH64 with seed 42."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    counts, total = np.zeros(64, np.int64), max(1, len(words) - width + 1)
    for at in range(0, total, BLOCK_WORDS):
        part = words[at : at + BLOCK_WORDS + width - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(width)), strict=False)) if len(words) >= width else [b" ".join(words)]
        hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprint_of_hashes(hashes: np.ndarray) -> int:
    """The 64-bit SimHash of shingles given by their hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK_WORDS):
        part = np.ascontiguousarray(hashes[at : at + BLOCK_WORDS])
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp): fp holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_rows(batches, "text"):
            texts = pc.fill_null(batch.column("text").cast(pa.binary()), b"").to_pylist()
            fps = [_signed(fingerprint(t, width)) for t in texts]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "fp": pa.array(fps, pa.int64())})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, fp bigint")


def _linked(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether fingerprints share the guaranteed positional bytes and, of those that do, differ in few enough bits."""
    differ = x ^ y
    tally = np.zeros(differ.shape, np.int8)
    for p in range(BYTES):
        tally += (differ & np.uint64(0xFF << (8 * p))) == 0
    return (tally >= MATCHES) & (np.bitwise_count(differ) <= BITS)


def _roots(fps: np.ndarray, positions: tuple[int, ...]) -> np.ndarray:
    """For distinct fingerprints that share the bytes at positions: the least index that each reaches within the list."""
    label = np.arange(len(fps))
    if len(fps) <= 2 * LIST_MOST or len(positions) < MATCHES:
        step = max(1, (1 << 20) // len(fps))
        links = [(i, _linked(fps[i : i + step, None], fps[None, :])) for i in range(0, len(fps), step)]
        pairs = [np.nonzero(m) for _, m in links]
        a = np.concatenate([p[0] + i for (i, _), p in zip(links, pairs, strict=True)])
        b = np.concatenate([p[1] for p in pairs])
    else:
        order = np.argsort(fps)
        free = [1 << (8 * p + k) for p in range(BYTES) if p not in positions for k in range(8)]
        found_a, found_b = [], []
        for n in range(1, BITS + 1):
            for flipped in combinations(free, n):
                want = fps ^ np.uint64(sum(flipped))
                at = np.minimum(np.searchsorted(fps, want, sorter=order), len(fps) - 1)
                hit = np.flatnonzero(fps[order[at]] == want)
                found_a.append(hit)
                found_b.append(order[at[hit]])
        a, b = np.concatenate(found_a), np.concatenate(found_b)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _scan(lists: list[tuple[int, ...]], most: int | None):
    """A function over partitions sorted by (k, fp & mask): links within lists, and the entries of lists above `most`."""
    masks = np.array([_mask(p) for p in lists], np.uint64)

    def links(k: int, fps: np.ndarray, reps: np.ndarray) -> list[tuple[int, int]]:
        order = np.argsort(reps)
        fps, reps = fps[order], reps[order]
        root = _roots(fps, lists[k])
        own = np.flatnonzero(root != np.arange(len(root)))
        return list(zip(reps[own].tolist(), reps[root[own]].tolist(), strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        carry, over = (none, none, none), None

        def out(edges, deferred):
            a = [e[0] for e in edges] + deferred[1].tolist()
            b = [e[1] for e in edges] + deferred[2].tolist()
            k = [-1] * len(edges) + deferred[0].tolist()
            return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "k": pa.array(k, pa.int32())})

        def settle(k, fp, rep, last: bool):
            """Links of the whole lists in these rows; the rows of the last list, if it may go on."""
            nonlocal over
            key = fp.view(np.uint64) & masks[k]
            cut = np.flatnonzero((k[1:] != k[:-1]) | (key[1:] != key[:-1])) + 1
            first, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(k)]])
            edges, later = [], []
            if not last:
                keep = first[-1]
                first, end = first[:-1], end[:-1]
            sizes = end - first
            two = first[sizes == 2]
            if len(two):
                hit = two[_linked(fp.view(np.uint64)[two], fp.view(np.uint64)[two + 1])]
                edges += list(zip(rep[hit].tolist(), rep[hit + 1].tolist(), strict=True))
            for i, n in zip(first[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                if most is not None and n > most:
                    later.append(slice(i, i + n))
                else:
                    edges += links(int(k[i]), fp[i : i + n].view(np.uint64), rep[i : i + n])
            rest = (none, none, none) if last else (k[keep:], fp[keep:], rep[keep:])
            late = [np.concatenate([none, *(x[s] for s in later)]) for x in (k, fp, rep)]
            return out(edges, late), rest

        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)]
            if over is not None and len(new[0]):  # a list that is deferred already goes on
                same = (new[0] == over[0]) & ((new[1].view(np.uint64) & masks[over[0]]) == over[1])
                n = len(same) if same.all() else int(np.argmin(same))
                if n:
                    yield out([], [x[:n] for x in new])
                    new = [x[n:] for x in new]
                if len(new[0]):
                    over = None
            k, fp, rep = (np.concatenate([c, x]) for c, x in zip(carry, new, strict=True))
            carry = (none, none, none)
            if not len(k):
                continue
            done, carry = settle(k, fp, rep, False)
            yield done
            if most is not None and len(carry[0]) > most:
                over = (int(carry[0][0]), carry[1].view(np.uint64)[0] & masks[carry[0][0]])
                yield out([], carry)
                carry = (none, none, none)
        if len(carry[0]):
            yield settle(*carry, True)[0]

    return run


def _listed(entries: DataFrame, lists: list[tuple[int, ...]]) -> DataFrame:
    """entries (k, fp, rep), where k says which list, brought together by list and sorted."""
    masks = F.array(*(F.lit(_signed(_mask(p))) for p in lists))
    entries = entries.withColumn("key", F.col("fp").bitwiseAND(F.element_at(masks, F.col("k") + 1)))
    return entries.repartition("k", "key").sortWithinPartitions("k", "key", "fp").select(F.col("k").cast("bigint").alias("k"), "fp", "rep")


def link(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) between reps of (fp, rep) that connect exactly the fingerprints linked by at most BITS differing bits."""
    listed = distinct.select(F.explode(F.array(*map(F.lit, range(len(TRIPLES))))).alias("k"), "fp", "rep")
    schema = "a bigint, b bigint, k int"
    found = stored(_listed(listed, TRIPLES).mapInArrow(_scan(TRIPLES, LIST_MOST), schema), "simhash-links")
    finer = [p for s in SPLIT for p in s]
    width = len(SPLIT[0])
    late = found.where("k >= 0").select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda j: F.col("k") * width + j)).alias("k"), F.col("a").alias("fp"), F.col("b").alias("rep"))
    return found.where("k < 0").select("a", "b").union(_listed(late, finer).mapInArrow(_scan(finer, None), schema).select("a", "b"))


def near_duplicates(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of docs (doc_id, text)."""
    rows = stored(fingerprints(docs, width), "simhash")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct")
    groups = components(link(distinct.where("rep is not null")))
    of = distinct.join(groups, F.col("rep") == F.col("node"), "left").select(F.col("fp").alias("_fp"), F.coalesce("component", "rep").alias("component_id"))
    text = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(of, F.col("fp") == F.col("_fp")).select("doc_id", text, "component_id")
