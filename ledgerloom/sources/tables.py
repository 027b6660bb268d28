"""Renewals from TSV, label stores from JSON lines, and the sinks of linkages and indexes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identifiers
from ..functions.text import decoded
from ..operators import labels, renewal
from . import xml

#: The two headers of renewal files.
HEADER = "entry_id volume part number page author title oreg odat id rdat claimants new_matter see_also_ren see_also_reg notes full_text".split()
DATABASE_HEADER = "entry_id volume part number page auth titl oreg odat id dreg claimants new_matter see_also_ren see_also_reg note full_text".split()

VAULT_SCHEMA = (
    "schema int, marc_control_id string, nypl_uuid string, verdict string, note string, labeled_at string, labeler string, "
    "marc_identifiers struct<lccn:string,oclc:string,isbns:array<string>>, cce_regnum string, cce_renewal_id string, cce_renewal_oreg string, "
    "categories array<string>, reg_year int, renewal_year int, was_renewed boolean, scores struct<weighted_mean:double,learned:double>, matcher_version string, match_source string"
)
PAIR = ["marc_control_id", "nypl_uuid"]


class HeaderError(ValueError):
    """A renewal file has neither of the two headers."""


def _lines(content: bytes) -> list[list[str]]:
    """The cells of each line."""
    try:
        return [line.split("\t") for line in content.decode("utf-8").splitlines()]
    except UnicodeDecodeError:
        return [[decoded(cell) for cell in line.split(b"\t")] for line in content.splitlines()]


def read_renewals(spark: SparkSession, path: str) -> DataFrame:
    """Renewals of all TSV files at path, in either header. Short rows and rows without ids are dropped; odd dates become null.

    A file that is UTF-8 is read as such; of any other one each cell is decoded by itself, so that a spoilt cell does not spoil the rest.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    names = HEADER

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for file, content in zip(frame["path"], frame["content"], strict=True):
                lines = _lines(bytes(content))
                header = [c.lstrip("﻿") for c in lines[0]] if lines else []
                if header not in (HEADER, DATABASE_HEADER):
                    raise HeaderError(f"{file}: unknown header {header}")
                for i, cells in enumerate(lines[1:]):
                    if len(cells) >= len(names):
                        out.append([*(c.strip() or None for c in cells[: len(names)]), f"{file}#{i:09d}"])
            yield pd.DataFrame(out, columns=[*names, "load_order"], dtype=object)

    df = files.mapInPandas(rows, ", ".join(f"{c} string" for c in [*names, "load_order"])).where("entry_id is not null and id is not null")
    for c in ("odat", "rdat"):
        day = F.when(F.col(c).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col(c).try_cast("date"))
        df = df.withColumn(c, F.when(F.year(day).between(*xml.REGISTRATION_YEARS), day))
    return df


def renewal_table(renewals: DataFrame) -> DataFrame:
    """(regnum, year, entry_id): the last loaded renewal of each key; renewals without a date have none."""
    keyed = renewals.select("entry_id", "load_order", F.explode(identifiers.renewal_keys(F.col("oreg"), F.year("odat"))).alias("k"))
    return renewal.last_renewals(keyed.select("k.regnum", "k.year", "entry_id", "load_order"), "load_order")


#: Version of the index layout, and of the parsers whose results it holds; an index of another one is built anew.
INDEX_VERSION, PARSER_VERSION = "2", "2"


def source_hash(spark: SparkSession, *paths: str) -> str:
    """A digest of the names, sizes and times of all files at the paths, in any order of listing."""
    files = None
    for path in paths:
        one = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")
        files = one if files is None else files.union(one)
    row = files.agg(F.sha2(F.array_join(F.sort_array(F.collect_list(F.concat_ws("|", "path", "length", F.col("modificationTime").cast("long")))), ";"), 256)).first()
    return row[0]


def build_index(registrations: DataFrame, renewals: DataFrame) -> DataFrame:
    """Registrations with their renewal, and with that of a sibling where they have none."""
    hits = renewal.first_hit(xml.registration_keys(registrations), renewal_table(renewals), "uuid")
    detail = renewals.select("entry_id", F.col("id").alias("renewal_id"), F.col("oreg").alias("renewal_oreg"), F.col("rdat").alias("renewal_date"), F.col("author").alias("renewal_author"), F.col("title").alias("renewal_title"), F.col("claimants").alias("renewal_claimants"), F.col("new_matter").alias("renewal_new_matter"))
    detail = labels.latest(detail, ["entry_id"], ["renewal_id"])
    joined = registrations.join(hits, "uuid", "left").join(detail, "entry_id", "left").withColumn("was_renewed", F.col("entry_id").isNotNull())
    records = joined.select("uuid", identifiers.normalize_regnum(F.col("regnum")).alias("regnum"), F.col("reg_year").alias("year"), F.transform("prev_regnums", identifiers.normalize_regnum).alias("cited"), "entry_id")
    records = records.withColumn("regnum", F.coalesce("regnum", F.lit("")))
    siblings = renewal.sibling_renewals(records, "uuid").select("uuid", F.col("sibling").alias("sibling_uuid"), F.col("sibling_entry").alias("sibling_renewal"))
    return joined.join(siblings, "uuid", "left").withColumn("is_range_registration", identifiers.is_multi_regnum(F.col("regnum")))


def write_index(index: DataFrame, path: str, source_hash: str) -> None:
    """The index by year, records sorted within files by year and id, with a row of metadata beside it."""
    spark = index.sparkSession
    index.repartition("reg_year").sortWithinPartitions("reg_year", "uuid").write.mode("overwrite").partitionBy("reg_year").parquet(f"{path}/registrations")
    _write_facts(spark, path, source_hash)


def _write_facts(spark: SparkSession, path: str, digest: str) -> None:
    spark.createDataFrame([(digest, INDEX_VERSION, PARSER_VERSION)], "source_hash string, version string, parser string").coalesce(1).write.mode("overwrite").parquet(f"{path}/metadata")


def _facts(spark: SparkSession, path: str):
    try:
        return spark.read.parquet(f"{path}/metadata").first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def index_is_current(spark: SparkSession, path: str, source_hash: str, force: bool = False) -> bool:
    """Whether the index at path was built from these sources, by this layout and these parsers; `force` says no."""
    row = _facts(spark, path)
    return not force and row is not None and (row["source_hash"], row["version"], row["parser"]) == (source_hash, INDEX_VERSION, PARSER_VERSION)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """All registrations of an index; filters on reg_year prune its folders."""
    return spark.read.parquet(f"{path}/registrations")


def index_counts(registrations: DataFrame, renewals: DataFrame) -> DataFrame:
    """One row: registrations, renewals, joined ones, year buckets, renewals that came by way of a sibling, ranges."""
    own = registrations.agg(
        F.count(F.lit(1)).alias("registrations"), F.count(F.when(F.col("was_renewed"), 1)).alias("joined"), F.countDistinct("reg_year").alias("years"),
        F.count("sibling_renewal").alias("propagated"), F.count(F.when(F.col("is_range_registration"), 1)).alias("ranges"))
    return own.crossJoin(renewals.agg(F.count(F.lit(1)).alias("renewals")))  # single rows


def prepare_marc(spark: SparkSession, source: str, path: str) -> bool:
    """Catalogue records of the XML files at source as Parquet at path, unless those there come from the same files. Whether they were written."""
    digest = source_hash(spark, source)
    if index_is_current(spark, path, digest):
        return False
    records, counts = xml.read_marc(spark, source)
    records.write.mode("overwrite").parquet(f"{path}/records")
    counts.write.mode("overwrite").parquet(f"{path}/counts")
    _write_facts(spark, path, digest)
    return True


def read_prepared(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/records")


def cached_frequencies(spark: SparkSession, path: str, digest: str, language: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Token weights from path if they are of these sources and this language; else they are built and kept there."""
    place = f"{path}/{language}"
    if not index_is_current(spark, place, digest):
        build().write.mode("overwrite").parquet(f"{place}/idf")
        _write_facts(spark, place, digest)
    return spark.read.parquet(f"{place}/idf")


PUBLISHERS = "canonical string, aliases array<string>, imprints array<string>"


def read_publishers(spark: SparkSession, path: str) -> DataFrame:
    """Publishing houses with other names and imprints, from one JSON document with a list of them."""
    return spark.read.schema(PUBLISHERS).option("multiLine", "true").option("mode", "FAILFAST").json(path)


def read_vault(spark: SparkSession, path: str) -> DataFrame:
    """Labelled pairs; a malformed line is an error."""
    return spark.read.schema(VAULT_SCHEMA).option("mode", "FAILFAST").json(path)


def read_vault_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a label store of any version, each with what it holds as a variant, for migration; nothing is dropped."""
    return spark.read.text(path).select(F.col("value").alias("line"), F.try_parse_json("value").alias("entry"))


def migrated_vault(spark: SparkSession, path: str) -> DataFrame:
    """A label store of any older version in the newest one; a malformed line is an error."""
    store = spark.read.schema(f"{VAULT_SCHEMA}, category string").option("mode", "FAILFAST").json(path)
    return labels.migrate(store)


def vault_marcs(spark: SparkSession, vault: DataFrame, pool: str, path: str) -> None:
    """The catalogue records that a label store names, as XML."""
    xml.write_marc(xml.read_wanted(spark, pool, vault.select(F.col("marc_control_id").alias("control_id"))), path)


def append_review(pairs: DataFrame, path: str) -> None:
    """Pairs to review, added to the table at path by language; ids that are there already stay as they are."""
    spark = pairs.sparkSession
    try:
        pairs = labels.missing(pairs, spark.read.parquet(path), ["id"])
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    pairs.write.mode("append").partitionBy("language").parquet(path)


def upsert_vault(store: DataFrame, entries: DataFrame) -> DataFrame:
    return labels.upsert(store, entries, PAIR, ["labeled_at"])


def write_linkage(rows: DataFrame, path: str, matches_only: bool = False, found: str | None = None) -> None:
    """Linkage rows as JSON lines; nulls become empty strings, so every line has every field."""
    text = rows.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in rows.columns))
    (text.where(F.col(found or ("match_source_id" if "match_source_id" in rows.columns else "match_id")) != "") if matches_only else text).write.mode("overwrite").json(path)
