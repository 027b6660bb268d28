"""What the corpus operators share: table access, durable intermediate tables, word segmentation and hashing."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: White space that separates words: [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_BREAK = np.zeros(256, bool)
WORD_BREAK[list(SPACES.encode())] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of text that the vectorised code looks at in one go.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    Where none is named, a session within one process gets a temporary folder of its own; on a cluster that is an error, for
    executors would write where nobody else can read.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="ledgerloom-")
        sc.setCheckpointDir(named)
    return named.rstrip("/")


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession, most: str = "8m") -> None:
    """Let plans of this session hand at most about `most` bytes of text at a time to Python, unless the session has a limit of its own.

    The default is eight times that, and a batch is held in several copies on either side. Results do not depend on it. The setting stays, for a
    returned DataFrame is planned when it is used.
    """
    if spark.conf.get(BATCH_BYTES, None) in (None, "64m", "67108864", "67108864b"):
        spark.conf.set(BATCH_BYTES, most)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back.

    This cuts the lineage: the table outlives the executors that wrote it, and later readers do not redo the work.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{label}-{uuid.uuid4().hex}"
    small_batches(spark)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete tables made by `stored` that nothing reads any more, and let Spark free the shuffle files of finished steps.

    Spark drops shuffle files when the driver's collector finds their owners gone, which on a calm driver may take very long.
    """
    for df in tables:
        path = getattr(df, "_stored_at", None)
        if path:
            jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)
    spark = next((df.sparkSession for df in tables if df is not None), None)
    if spark is not None:
        gc.collect()
        spark._jvm.System.gc()


def schema_with(df: DataFrame, keep: tuple[str, ...], more: str) -> StructType:
    """The schema of df's `keep` columns followed by the columns that the DDL text `more` names."""
    return StructType([*df.select(*keep).schema.fields, *StructType.fromDDL(more).fields])


def fold(column: str, modulus: int) -> Column:
    """crc32 of an integer column's decimal text, modulo modulus; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus).cast("long"))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def split_rows(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about `most` bytes of text, or one row if that row is longer."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(at)), 0), dtype=np.int64)
        total, first = 0, 0
        for row, size in enumerate(lengths.tolist()):
            if total and total + size > most:
                yield batch.slice(first, row - first)
                total, first = 0, row
            total += size
        if first < batch.num_rows:
            yield batch.slice(first)


def flat_text(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and the offset of each text (one more than there are texts). Null counts as empty."""
    array = pc.fill_null(array.cast(pa.large_string()), "")
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    data = array.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def word_spans(raw: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = WORD_BREAK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each run of bytes outside `breaks` (white space); no word crosses two texts."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~breaks[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(raw), bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(raw), bool)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


#: Bytes of words that are hashed in one go.
HASH_BYTES = 1 << 19


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, A-Z folded to a-z; memory is bounded by HASH_BYTES or the longest word."""
    out = np.zeros(len(starts), np.uint64)
    upto = np.cumsum(ends - starts)
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + HASH_BYTES, side="right")))
        out[at:stop] = _hashed(raw, starts[at:stop], ends[at:stop])
        at = stop
    return out


def _hashed(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sizes = ends - starts
    places = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    letters = LOWER[raw[np.repeat(starts, sizes) + places]].astype(np.uint64) + np.uint64(1)
    power = np.cumprod(np.full(int(sizes.max()), 0x9E3779B97F4A7C15, np.uint64))
    return _mixed(np.add.reduceat(letters * power[places], np.cumsum(sizes) - sizes))


def labelled_sample(docs: DataFrame, target: Column, folds: int, held: int, most: int) -> DataFrame:
    """At most about `most` rows with a label for which crc32(doc_id) mod folds is not held, the same ones on every run.

    Rows are chosen by a hash of doc_id against the share that `most` is of all labelled rows, so the choice needs one count and no sort.
    """
    rows = docs.where(target.isNotNull() & (fold("doc_id", folds) != held))
    n = rows.count()
    share = min(1.0, most / max(n, 1))
    return rows.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 20)) < int(share * (1 << 20)) + (share >= 1.0))


#: Bytes of text that a fitted sample may have.
SAMPLE_BYTES = 96_000_000


def bounded_texts(docs: DataFrame, chosen: DataFrame, most: int = SAMPLE_BYTES) -> DataFrame:
    """docs' rows of chosen (doc_id, ...), whole texts; where these have more than `most` bytes together, a share of them by a hash of doc_id that has about that many."""
    rows = docs.join(F.broadcast(chosen), "doc_id")  # chosen is a bounded sample
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if total <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("bytes")), F.lit(1 << 20)) < int(most / total * (1 << 20)))
