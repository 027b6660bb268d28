"""Exact removal of repeated passages by common-prefix interval trees over distributed suffix arrays.

A byte is removed if a string of `length` bytes that covers it also starts anywhere else, in the same text or another one.

Sorting all suffixes of a corpus is not needed: every window of `length` bytes has an anchor, the place of the least hash of
`GRAM` bytes in it (the last one of equal hashes). The anchor depends on the window alone, so equal windows have equal
anchors, at equal offsets. Each window belongs to one anchor, and an anchor's windows are neighbours; their bytes to the left and right
of the anchor are its contexts, at most `length` bytes each. Only anchors whose hash occurs twice can have repeated windows.

1. `anchor_hashes`: the anchor hashes of each text, counted over the corpus.
2. `contexts`: for hashes that occur twice, the left and right contexts of each place; equal ones of a text are one row.
3. `repeats`: rows of one hash come together. Their sorted right contexts are a suffix array; neighbouring common prefixes give, in a
   stack scan, the tree of common-prefix intervals. The members of an interval, sorted by their left contexts, are scanned again: an
   interval of that scan shares both sides. It is maximal if its members are diverse on the left and on the right; `maximal_repeats`
   gives every such group with all its members, and `repeat_groups` all groups of a corpus with all their occurrences.
4. `hot_repeats`: a hash that more than `HOT` texts have is not brought into one task; HOT bounds a task's memory and changes no result. Equal contexts are combined before the shuffle,
   and what is left is dealt by hash and window, so that its rows spread over as many keys as an anchor has windows.
5. `apply`: the places of each text are merged and cut out.

Texts that occur twice as a whole are counted by their MD5 digest and searched once. Defined results: a null text has no bytes and the digest of
the empty string; texts below `length` bytes lose nothing; a text of `length` bytes or more that another row repeats loses all;
repeated rows are repeats of one another.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import discard, flat_text, schema_with, split_rows, stored, text_or_empty

LENGTH = 400
GRAM = 64
#: Bytes of text that are hashed in one go; the hashes and their minima take some hundred times that.
SLICE = 1 << 19
#: Texts with one hash above which the hash is dealt out by its windows: below, its contexts take some 25 MB of a task.
HOT = 1 << 15
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if not _powers or len(_powers[0][0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _BASE, np.uint64)]))
        down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, pow(_BASE, -1, 1 << 64), np.uint64)]))
        _powers[0] = (up, down)
    return _powers[0]


def _gram_hashes(raw: np.ndarray, width: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the `width` bytes at each place."""
    up, down = _power_tables(len(raw) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)])])
    h = (sums[width:] - sums[:-width]) * down[: len(raw) - width + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def anchors(raw: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Per anchor: text number, place, hash, and the least and most bytes by which its windows begin before it."""
    none = np.zeros(0, np.int64)
    if len(raw) < length:
        return none, none, none.astype(np.uint64), none, none
    h = _gram_hashes(raw)
    width = length - GRAM + 1
    low = (h & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - np.arange(len(h), dtype=np.uint64))
    span = 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if width > span:
        low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
    place = (np.uint64(0xFFFFFFFF) - (low & np.uint64(0xFFFFFFFF))).astype(np.int64)
    start = np.arange(len(place))
    text = np.searchsorted(offsets, start, side="right") - 1
    inside = start + length <= offsets[text + 1]
    start, place, text = start[inside], place[inside], text[inside]
    if not len(start):
        return none, none, none.astype(np.uint64), none, none
    first = np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])])
    begin = np.flatnonzero(first)
    end = np.concatenate([begin[1:], [len(start)]]) - 1
    at = place[begin]
    return text[begin], at - offsets[text[begin]], h[at], at - start[end], at - start[begin]


def _searched(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, key, text) of the texts that are long enough; key is the MD5 digest of the text."""
    long_ = docs.where(F.octet_length("text") >= length)
    return long_.select("doc_id", F.unhex(F.md5(F.col("text").cast("binary"))).alias("key"), "text")


def anchor_hashes(texts: DataFrame, length: int) -> DataFrame:
    """(h, k1, k2, n): the anchor hashes of each text, the halves of its key, and how often it has the hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_rows(batches, "text", SLICE):
            raw, offsets = flat_text(batch.column("text"))
            text, _, h, _, _ = anchors(raw, offsets, length)
            order = np.lexsort((h, text))
            text, h = text[order], h[order]
            first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (h[1:] != h[:-1])])) if len(h) else np.zeros(0, np.int64)
            n = np.diff(np.concatenate([first, [len(h)]]))
            halves = np.frombuffer(b"".join(batch.column("key").to_pylist()), ">i8").astype(np.int64).reshape(-1, 2)[text[first]]
            columns = {"h": pa.array(h[first].view(np.int64), pa.int64()), "k1": pa.array(halves[:, 0]), "k2": pa.array(halves[:, 1]), "n": pa.array(n, pa.int64())}
            yield pa.RecordBatch.from_pydict(columns)

    return texts.mapInArrow(run, "h bigint, k1 bigint, k2 bigint, n bigint")


CONTEXTS = "h bigint, key binary, left binary, right binary, places array<bigint>, hot boolean"


def contexts(wanted: DataFrame, length: int) -> DataFrame:
    """From (key, text, hs): per repeated hash (h, hot) of a text its contexts, the left one reversed, and the places that have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_rows(batches, "text", SLICE):
            raw, offsets = flat_text(batch.column("text"))
            text, place, h, least, most = anchors(raw, offsets, length)
            keys, lists = batch.column("key").to_pylist(), batch.column("hs")
            sought = np.concatenate([np.repeat(np.arange(len(keys)), np.asarray(pc.list_value_length(lists))), np.zeros(0, np.int64)]).astype(np.int64)
            flat = lists.flatten()
            pairs = np.zeros(len(sought), dtype=[("t", np.int64), ("h", np.int64)])
            pairs["t"], pairs["h"] = sought, flat.field("h").to_numpy(zero_copy_only=False)
            hot = set(np.asarray(flat.field("h"))[np.asarray(flat.field("hot"))].tolist())
            have = np.zeros(len(text), dtype=pairs.dtype)
            have["t"], have["h"] = text, h.view(np.int64)
            hit = np.flatnonzero(np.isin(_packed(have), _packed(pairs)))
            data, found = raw.tobytes(), {}
            for i in hit.tolist():
                at = int(offsets[text[i]] + place[i])
                left, right = data[at - int(most[i]) : at][::-1], data[at : at + length - int(least[i])]
                found.setdefault((int(text[i]), int(have["h"][i]), left, right), []).append(int(place[i]))
            columns = {
                "h": pa.array([k[1] for k in found], pa.int64()), "key": pa.array([keys[k[0]] for k in found], pa.binary()),
                "left": pa.array([k[2] for k in found], pa.binary()), "right": pa.array([k[3] for k in found], pa.binary()),
                "places": pa.array(list(found.values()), pa.list_(pa.int64())), "hot": pa.array([k[1] in hot for k in found], pa.bool_()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return wanted.mapInArrow(run, CONTEXTS)


def _packed(pairs: np.ndarray) -> np.ndarray:
    """(text, hash) pairs of one batch as single numbers; a text's number is mixed into the hash."""
    return pairs["h"].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + pairs["t"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    return n - ((int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])).bit_length() + 7) // 8


def intervals(prefixes: list[int]) -> Iterator[tuple[int, int, int]]:
    """The common-prefix intervals (value, first, last) of a sorted list whose neighbours share `prefixes`, children first."""
    stack: list[tuple[int, int]] = []
    for i, value in enumerate([*prefixes, -1]):
        first = i
        while stack and stack[-1][0] > value:
            held, first = stack.pop()
            yield held, first, i
        if not stack or stack[-1][0] < value:
            stack.append((value, first))


def maximal_repeats(members: list[tuple[bytes, bytes]], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """For distinct (left, right) contexts of one anchor hash: every maximal repeat of `length` bytes or more.

    Gives the bytes that all members of a group share to the left and to the right of the anchor, and the members. A group is diverse on both
    sides: on the left because it is an interval of the left contexts, on the right because some neighbours share no more.
    """
    order = sorted(range(len(members)), key=lambda i: members[i][1])
    shared = [_common(members[a][1], members[b][1]) for a, b in zip(order, order[1:], strict=False)]
    for right, first, last in intervals(shared):
        least = length - right
        group = [(members[order[i]][0], i) for i in range(first, last + 1) if len(members[order[i]][0]) >= least]
        if len(group) < 2:
            continue
        breaks = [k for k in range(first, last) if shared[k] == right]
        group.sort()
        beside = [_common(a[0], b[0]) for a, b in zip(group, group[1:], strict=False)]
        for left, i, j in intervals(beside):
            if left < least:
                continue
            places = sorted(place for _, place in group[i : j + 1])
            at = bisect_left(breaks, places[0])
            if at < len(breaks) and breaks[at] < places[-1]:  # diverse on the right: not all lie between the same breaks
                yield left, right, [order[p] for p in places]


def _members(rows: list[tuple]) -> tuple[list[tuple[bytes, bytes]], list[list[int]]]:
    """The distinct contexts of rows (key, left, right, places), and the rows of each."""
    same: dict[tuple[bytes, bytes], list[int]] = {}
    for i, (_, left, right, _) in enumerate(rows):
        same.setdefault((left, right), []).append(i)
    return list(same), list(same.values())


def _groups(rows: list[tuple], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeats of the rows of one hash as (left, right, rows); equal contexts that occur twice are a group of their own."""
    if len(rows) == 1 and len(rows[0][3]) == 1:
        return
    members, own = _members(rows)
    for (left, right), at in zip(members, own, strict=True):
        if len(at) > 1 or len(rows[at[0]][3]) > 1:
            yield len(left), len(right), at
    if len(members) > 1:
        for left, right, group in maximal_repeats(members, length):
            yield left, right, [i for m in group for i in own[m]]


def _spans(rows: list[tuple], length: int) -> Iterator[tuple[bytes, int, int]]:
    """(key, first, end) of the bytes that repeats of the rows of one hash cover; all of a place's repeats hold its anchor, so they are one span."""
    reach: dict[int, tuple[int, int]] = {}
    for left, right, group in _groups(rows, length):
        for i in group:
            had = reach.get(i, (0, 0))
            reach[i] = max(had[0], left), max(had[1], right)
    for i, (left, right) in reach.items():
        for at in rows[i][3]:
            yield rows[i][0], at - left, at + right


def _solved(found: DataFrame, solve, schema: str) -> DataFrame:
    """solve(rows of one hash) for contexts of one hash after another, as a table of the schema."""
    names = [f.name for f in schema_of(schema)]
    types = [{"binary": pa.binary(), "bigint": pa.int64()}[f.dataType.simpleString()] for f in schema_of(schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(made: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*made, strict=True)) or [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        held, rows = None, []
        for batch in batches:
            made: list[tuple] = []
            for h, *row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if h != held:
                    made.extend(solve(held, rows) if rows else ())
                    held, rows = h, []
                rows.append(tuple(row))
            yield out(made)
        if rows:
            yield out(list(solve(held, rows)))

    return found.select("h", "key", "left", "right", "places").repartition("h").sortWithinPartitions("h").mapInArrow(run, schema)


def schema_of(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


SPANS = "key binary, first bigint, end bigint"


def repeats(found: DataFrame, length: int) -> DataFrame:
    """(key, first, end): places of each text that repeated windows cover, from contexts whose lists fit into a task."""
    return _solved(found, lambda _, rows: _spans(rows, length), SPANS)


def _windows(distinct: DataFrame, length: int) -> DataFrame:
    """(h, c1, c2, n, w, o): each window of a context, as a hash of its bytes, and by how much it begins before the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, sizes, before = [np.zeros(0, np.uint64)], [], [np.zeros(0, np.int64)]
            for left, right in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True):
                own = _gram_hashes(np.frombuffer(left[::-1] + right, np.uint8), length)
                hashes.append(own)
                sizes.append(len(own))
                before.append(len(left) - np.arange(len(own)))
            row = np.repeat(np.arange(batch.num_rows), np.array(sizes, np.int64))
            columns = {c: batch.column(c).take(pa.array(row)) for c in ("h", "c1", "c2", "n")}
            yield pa.RecordBatch.from_pydict(columns | {"w": pa.array(np.concatenate(hashes).view(np.int64)), "o": pa.array(np.concatenate(before))})

    return distinct.select("h", "c1", "c2", "n", "left", "right").mapInArrow(run, "h bigint, c1 bigint, c2 bigint, n bigint, w bigint, o bigint")


def hot_repeats(found: DataFrame, length: int) -> DataFrame:
    """(key, first, end) as `repeats` gives them, from contexts of hashes that very many texts have.

    Equal contexts are one row with its count (combined before the shuffle; told apart by 128 bits of hash). A window is repeated if
    its contexts count two or more; each context reaches from its first to its last repeated window.
    """
    digest = F.md5(F.concat("left", F.lit(b"\x00"), "right", F.lit(b"\x00"), F.octet_length("left").cast("string").cast("binary")))
    half = lambda at: F.conv(F.substring(digest, at, 16), 16, -10).cast("bigint")
    members = found.select("*", half(1).alias("c1"), half(17).alias("c2"))
    distinct = stored(members.groupBy("h", "c1", "c2").agg(F.sum(F.size("places").cast("bigint")).alias("n"), F.first("left").alias("left"), F.first("right").alias("right")), "hot-contexts")
    # One pass and one exchange: every window sees how many places have its bytes.
    seen = F.sum("n").over(Window.partitionBy("h", "w"))
    windows = _windows(distinct, length).withColumn("_n", seen).where("_n > 1")
    reach = windows.groupBy("h", "c1", "c2").agg(F.min("o").alias("low"), F.max("o").alias("high"))
    reach = stored(reach, "hot-reach").select(F.col("h").alias("_h"), F.col("c1").alias("_c1"), F.col("c2").alias("_c2"), "low", "high")
    discard(distinct)
    placed = members.select("h", "c1", "c2", "key", F.explode("places").alias("at"))
    placed = placed.join(reach, (F.col("h") == F.col("_h")) & (F.col("c1") == F.col("_c1")) & (F.col("c2") == F.col("_c2")))
    return placed.select("key", (F.col("at") - F.col("high")).alias("first"), (F.col("at") + length - F.col("low")).alias("end"))


def repeated_contexts(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """The table of contexts of repeated hashes, and (key, n, rep): how often each distinct text occurs."""
    texts = _searched(docs, length)
    rows = stored(texts.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("rep")), "text-counts")
    hashes = stored(anchor_hashes(texts, length), "anchor-hashes")
    seen = hashes.groupBy("h").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("texts"), *(f(c).alias(f"{f.__name__}_{c}") for c in ("k1", "k2") for f in (F.min, F.max)))
    again = seen.where("n > 1 or min_k1 <> max_k1 or min_k2 <> max_k2").select(F.col("h").alias("_h"), (F.col("texts") > hot).alias("hot"))
    key = F.unhex(F.concat(F.lpad(F.hex("k1"), 16, "0"), F.lpad(F.hex("k2"), 16, "0")))
    sought = hashes.join(again, F.col("h") == F.col("_h")).groupBy("k1", "k2").agg(F.collect_set(F.struct("h", "hot")).alias("hs")).select(key.alias("_k"), "hs")
    sought = stored(sought, "sought-hashes")
    discard(hashes)
    of_rep = sought.join(rows.select(F.col("key").alias("_key"), "rep"), F.col("_k") == F.col("_key")).select("_k", "rep", "hs")
    wanted = texts.join(of_rep, (F.col("key") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("rep"))).select("key", "text", "hs")
    found = stored(contexts(wanted, length), "repeat-contexts")
    discard(sought)
    return found, rows


def repeat_groups(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(h, g, left, right, key, place): every maximal repeat group with all its occurrences.

    A group is told by h, its anchor's hash, and its number g among that hash's groups; the bytes shared to the left and right of the anchor, `left` and `right` (up to `length` each, as far as contexts
    go); key is the MD5 digest of a text and place the byte at which the repeat begins. Texts of equal key occur as often as the corpus has them.
    """
    found, _ = repeated_contexts(docs, length)

    def solve(h: int, rows: list[tuple]) -> Iterator[tuple]:
        for g, (left, right, group) in enumerate(_groups(rows, length)):
            for i in group:
                for at in rows[i][3]:
                    yield h, g, left, right, rows[i][0], at - left

    return _solved(found, solve, "h bigint, g bigint, left bigint, right bigint, key binary, place bigint")


def spans(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(key, n, spans): per distinct text of `length` bytes or more how often it occurs, and the parts that repeated windows cover."""
    found, rows = repeated_contexts(docs, length, hot)
    places = repeats(found.where("not hot"), length)
    crowded = found.where("hot")
    if not crowded.isEmpty():
        places = places.union(hot_repeats(crowded, length))
    places = stored(places.groupBy("key").agg(F.collect_list(F.struct("first", "end")).alias("spans")), "repeat-places")
    discard(found)
    places = places.select(F.col("key").alias("_k"), "spans")
    return rows.join(places, F.col("key") == F.col("_k"), "left").where("n > 1 or spans is not null").select("key", "n", "spans")


def _merged(spans: list[dict] | None, n: int | None, size: int, length: int) -> list[tuple[int, int]]:
    if size < length:
        return []
    if n is not None and n > 1:
        return [(0, size)]
    out: list[list[int]] = []
    for first, end in sorted((s["first"], s["end"]) for s in spans or ()):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return [tuple(x) for x in out]


def apply(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """docs' `keep` columns with n_bytes, n_removed, n_spans, kept_sha256 and kept_text.

    kept_text drops what is left of a character that was cut through; the digest is of the remaining bytes as they are.
    """
    whole = text_or_empty()
    left = docs.select(*keep, whole.alias("_text"), F.unhex(F.md5(whole.cast("binary"))).alias("_key"))
    info = spans(docs, length, hot).select(F.col("key").alias("_k"), F.col("n").alias("_n"), F.col("spans").alias("_spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_rows(batches, "_text", SLICE):
            columns: dict[str, list] = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")}
            for text, n, places in zip(*(batch.column(c).to_pylist() for c in ("_text", "_n", "_spans")), strict=True):
                raw = text.encode("utf-8")
                cut = _merged(places, n, len(raw), length)
                rest, at = [], 0
                for first, end in cut:
                    rest.append(raw[at:first])
                    at = end
                rest = b"".join([*rest, raw[at:]])
                for c, v in zip(columns, (len(raw), len(raw) - len(rest), len(cut), hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "ignore")), strict=True):
                    columns[c].append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            made = {c: pa.array(v, t) for (c, v), t in zip(columns.items(), types, strict=True)}
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in keep} | made)

    schema = schema_with(docs, keep, "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string")
    return left.join(info, F.col("_key") == F.col("_k"), "left").select(*keep, "_text", "_n", "_spans").mapInArrow(run, schema)
