"""Structured Streaming: latest-wins tables, linkage of arriving records, and windowed counts."""

from __future__ import annotations

import re
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators import labels, scoring


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared one that the session names; a session within one process may do without."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.gettempdir()
    return f"{named.rstrip('/')}/streams/{uuid.uuid4().hex}"


def _source(spark: SparkSession, path: str, files_per_trigger: int = 4) -> DataFrame:
    """A stream of the Parquet files at path, a folder or one file, a few per micro-batch."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rstrip("/").rpartition("/")
    # A pattern that only this name matches: the stream reads folders, and takes a pattern for one.
    exact = f"{folder}/[{name[0]}]{name[1:]}"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(exact)


def _run(writer) -> None:
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def latest_of_files(spark: SparkSession, path: str, keys: list[str], order: list[str], parts: int = 16) -> DataFrame:
    """The last row of each key of all files at path, kept as a table that every micro-batch is merged into.

    The table lies in parts by a hash of the key. A merge reads and writes only the parts that its batch has keys of, each as a new version named by the
    batch, so a batch that is run again after a failure gives the same versions. Versions that a later batch has replaced are deleted.
    """
    base = scratch(spark)
    current: dict[int, list[int]] = {}

    def merge(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        changes = labels.latest(batch, keys, order).withColumn("_part", F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))
        touched = sorted(r[0] for r in changes.select("_part").distinct().collect())
        older = {p: v for p in touched if (v := max((n for n in current.get(p, []) if n < number), default=None)) is not None}
        if older:
            before = session.read.parquet(*(f"{base}/v{v}/_part={p}" for p, v in older.items()))
            changes = labels.upsert(before, changes.drop("_part"), keys, order).withColumn("_part", F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))
        changes.write.mode("overwrite").partitionBy("_part").parquet(f"{base}/v{number}")
        for p in touched:
            current.setdefault(p, []).append(number)
        for p, v in older.items():
            where = session._jvm.org.apache.hadoop.fs.Path(f"{base}/v{v}/_part={p}")
            where.getFileSystem(session._jsc.hadoopConfiguration()).delete(where, True)

    _run(_source(spark, path).writeStream.foreachBatch(merge).option("checkpointLocation", f"{base}/checkpoint"))
    if not current:
        return spark.read.parquet(path).limit(0)
    return spark.read.parquet(*(f"{base}/v{max(v)}/_part={p}" for p, v in current.items()))


def daily_counts(spark: SparkSession, path: str, late: str = "1 day") -> DataFrame:
    """Rows and sums by day and type: windowed aggregation under a watermark; every change replaces its window's row."""
    base = scratch(spark)
    events = _source(spark, path).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    counts = events.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    counts = counts.select(F.col("w.start").alias("day"), "event_type", "n", "total")

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{base}/out/batch={number:06d}")

    _run(counts.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{base}/checkpoint"))
    rows = spark.read.option("recursiveFileLookup", "true").parquet(f"{base}/out")
    return labels.latest(rows, ["day", "event_type"], ["batch"]).drop("batch").withColumn("day", F.col("day").cast("timestamp_ntz"))


def link_stream(records: DataFrame, index: DataFrame, floor: float, path: str, checkpoint: str):
    """A query that appends the top matches of arriving (query, token) records against a static index (token, key, weight)."""

    def link(batch: DataFrame, number: int) -> None:
        pairs = batch.join(index, "token").groupBy("query", "key").agg(F.sum("weight").alias("score"))
        scoring.top_matches(pairs, "query", "key", "score", floor).write.mode("overwrite").parquet(f"{path}/batch={number:06d}")

    return records.writeStream.foreachBatch(link).option("checkpointLocation", checkpoint)


class Progress(StreamingQueryListener):
    """Running totals of streaming queries: rows, batches, rows a second, and whether one has stalled (no rows for `stall` batches)."""

    def __init__(self, stall: int = 10):
        self.rows, self.batches, self.idle, self.stall, self.rate, self.ended = 0, 0, 0, stall, 0.0, []

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        n = event.progress.numInputRows
        self.rows, self.batches, self.rate = self.rows + n, self.batches + 1, event.progress.processedRowsPerSecond
        self.idle = 0 if n else self.idle + 1

    def onQueryIdle(self, event) -> None:  # noqa: N802
        self.idle += 1

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended.append(str(event.id))

    @property
    def stalled(self) -> bool:
        return self.idle >= self.stall

    def remaining(self, total: int) -> float | None:
        """Seconds until `total` rows at the present rate."""
        return (total - self.rows) / self.rate if self.rate else None


def stop_gracefully(query, seconds: float = 60.0) -> bool:
    """Let the batch that runs finish, then stop; whether it did in time. A query that is stopped resumes from its checkpoint."""
    deadline = time.monotonic() + seconds
    # One idle look is the answer: a query without new data is active again for a moment whenever it polls its source.
    while not (finished := not query.isActive or not query.status["isTriggerActive"]) and time.monotonic() < deadline:
        time.sleep(0.1)
    query.stop()
    return finished


def counted_records(lines: DataFrame, schema: str) -> tuple[DataFrame, Observation]:
    """Records parsed from JSON lines (value), and an observation of how many were kept and skipped; a bad line never stops the rest."""
    seen = Observation("records")
    parsed = lines.select(F.from_json("value", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    good = F.col("r").isNotNull() & F.col("r._bad").isNull()
    return parsed.observe(seen, F.count(F.when(good, 1)).alias("kept"), F.count(F.when(~good, 1)).alias("skipped")).where(good).select("r.*").drop("_bad"), seen
