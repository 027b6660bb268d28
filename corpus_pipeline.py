"""Corpus pipeline: language ID, near-duplicate removal, repeated passages, mixing and tokenisation, in that order.

Every stage takes (spark, docs, sf_dir) and works on all rows of docs. All but the last return the columns of docs. Extra columns
are carried along whatever their names: the operators see the columns they need and the whole row as one struct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import langid, sentencepiece_codec, shingle_join, suffix_dedup
from ledgerloom.llm.common import discard, small_batches, stored
from ledgerloom.llm.mixing import mix_sources
from ledgerloom.llm.queries import tokenizer_path

#: Language scores below this are rejected: a margin of at most one byte.
LEAST_LANGUAGE_SCORE = 0.08

#: Repeated passages are cut from this length on: 51 words of prose have some 260 bytes or more.
PASSAGE_BYTES = 256


def _with_row(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select("doc_id", "lang", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told clearly. Null texts, texts without a letter and narrow margins go."""
    found = langid.predict(_with_row(docs), keep=("_row",), least=LEAST_LANGUAGE_SCORE)
    return found.where(~F.col("rejected")).select("_row.*")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest doc_id: texts whose five-word shingles have Jaccard similarity 0.8 or more.

    SimHash fingerprints and their byte-position index find candidates first; an exact index of shingles finds the pairs that differ in more bits.
    """
    return shingle_join.one_of_each(docs, width=5)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of PASSAGE_BYTES or more that are repeated anywhere; those of which nothing remains go.

    The stage has a length of its own, shorter than that of the query over whole documents, for passages of 51 words must go here.
    A text that lost nothing stays as it is, also null and empty ones; characters cut in half go whole.
    """
    cut = suffix_dedup.apply(_with_row(docs), keep=("_row",), length=PASSAGE_BYTES).where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_bytes")))
    new = {"text": F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("_row.text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_row.n_chars"))
    return cut.select(*(new[c].alias(c) if c in new else F.col(f"_row.`{c}`") for c in docs.columns))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: rows with null or repeated ids are documents of their own, empty and null texts stay once."""
    rows = stored(docs.select("doc_id", "source", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.monotonically_increasing_id().alias("_row_id")), "mix-rows")
    copies = mix_sources(rows.select("doc_id", "source", "text", "_row_id"), keep=("_row_id",)).where("copies > 0").select(F.col("_row_id").alias("_mixed_id"), "copies")
    both = rows.join(copies, F.col("_row_id") == F.col("_mixed_id"))
    return both.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("_row.*")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every text, with their digest and that of the text decoded from them; one row per row, null texts have no ids."""
    small_batches(spark)
    return sentencepiece_codec.digests(docs, tokenizer_path(), keep=("doc_id", "lang", "source"), with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("mix_to_weights", mix_to_weights),
    ("sentencepiece", sentencepiece),
]

#: The language model and the tokenizer cannot be expressed in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, stored(stage(spark, docs, sf_dir), name)
        discard(before)
    return docs
