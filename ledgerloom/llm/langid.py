"""Language identification by compression.

Per language a raw-content zstandard dictionary is made of labelled sample texts, reduced to letters in lower
case. A text, reduced alike, is compressed with each dictionary;
the language whose dictionary gives the fewest bytes is chosen. The score is 1 - exp(-margin / SCALE), where the margin is the
bytes saved against the next best language, so it is near 0 where the two are level; `rejected` marks scores below `least`.

The sample is bounded: at most about `sample_rows` labelled documents per language, and `dictionary_bytes` of their text. Two
passes choose it: a count per language, then a hash of doc_id against each language's share.

Defined results: null texts and texts without a letter are `und` with score 0, and rejected; equal sizes go to the language
that sorts first; repeated rows get equal results; without any labelled document every text is `und`.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, schema_with, split_rows

LETTER = re.compile(r"[^\W\d_]")
NO_LETTERS = re.compile(r"[\W\d_]+")
SCALE = 12.0
LEVEL = 6
#: Longer texts are compressed in pieces of this many characters, so that each piece is compared with the dictionary; all pieces count.
PIECE = 4096


def letters(text: str) -> str:
    """The text's letters in lower case; everything between them is one space."""
    return NO_LETTERS.sub(" ", text.lower())


def training_rows(docs: DataFrame, folds: int = 4, held: int = 2) -> Column:
    return F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", folds) != held)


def dictionaries(rows: DataFrame, sample_rows: int = 150, dictionary_bytes: int = 128_000, all_bytes: int = 64_000_000, most_languages: int = 10_000) -> dict[str, bytes]:
    """A dictionary per language from rows (doc_id, lang, text), made of sampled whole texts, in the order of their hashes, up to its size.

    All dictionaries together have `all_bytes` at most, so that many languages have smaller ones; every language is in. More than
    `most_languages` different values are an error: then the column holds no languages.
    """
    counts = rows.groupBy("lang").count().limit(most_languages + 1).collect()
    if len(counts) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    if not counts:
        return {}
    dictionary_bytes = min(dictionary_bytes, all_bytes // len(counts))
    # A text has some hundred bytes at least, so a small dictionary needs few.
    sample_rows = max(1, min(sample_rows, dictionary_bytes // 100))
    shares = {r["lang"]: min(1.0, sample_rows / r["count"]) for r in counts}
    grid = 1 << 24
    share = F.element_at(F.create_map(*(F.lit(x) for k, v in shares.items() for x in (k, int(v * grid)))), F.col("lang"))
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("language")), F.lit(grid))
    sample = rows.where(place < share).select("lang", place.alias("p"), F.col("text").alias("t")).collect()
    texts: dict[str, list[tuple[int, bytes]]] = {k: [] for k in shares}
    for r in sample:
        texts[r["lang"]].append((r["p"], letters(r["t"]).encode("utf-8")))
    out = {lang: b"\n".join(t for _, t in sorted(found))[:dictionary_bytes] for lang, found in sorted(texts.items())}
    return {lang: data for lang, data in out.items() if data}


class Classifier:
    def __init__(self, data: dict[str, bytes], level: int = LEVEL):
        import zstandard

        self.langs = sorted(data)
        self.coders = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(data[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.coders.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def one(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.langs or not LETTER.search(text):
            return "und", 0.0
        text = letters(text)
        sizes = [0] * len(self.langs)
        for at in range(0, len(text), PIECE):
            raw = text[at : at + PIECE].encode("utf-8")
            for k, coder in enumerate(self.coders):
                sizes[k] += len(coder.compress(raw))
        best = min(range(len(sizes)), key=sizes.__getitem__)
        rest = sizes[:best] + sizes[best + 1 :]
        margin = min(rest) - sizes[best] if rest else SCALE
        return self.langs[best], 1.0 - math.exp(-margin / SCALE)


def identify(docs: DataFrame, data: dict[str, bytes], keep: tuple[str, ...] = ("doc_id",), least: float = 0.15) -> DataFrame:
    """docs' `keep` columns with lang_pred, score and rejected."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(data)  # bounded by all_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = None
        for batch in split_rows(batches, "_text"):
            classifier = classifier or Classifier(shared.value)
            found = [classifier.one(t) for t in batch.column("_text").to_pylist()]
            columns = {c: batch.column(c) for c in keep}
            columns |= {"lang_pred": pa.array([x[0] for x in found], pa.string()), "score": pa.array([x[1] for x in found], pa.float64())}
            yield pa.RecordBatch.from_pydict(columns | {"rejected": pa.array([x[0] == "und" or x[1] < least for x in found], pa.bool_())})

    schema = schema_with(docs, keep, "lang_pred string, score double, rejected boolean")
    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, schema)


def predict(docs: DataFrame, folds: int = 4, held: int = 2, keep: tuple[str, ...] = ("doc_id",), least: float = 0.15) -> DataFrame:
    """Dictionaries from the labelled documents outside the held-out fold, then a prediction for every document."""
    data = dictionaries(docs.where(training_rows(docs, folds, held)))
    return identify(docs, data, keep, least)
