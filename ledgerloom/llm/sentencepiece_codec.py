"""SentencePiece encoding and decoding with a table of distinct marked words.

In the model's text, white space is a marker (U+2581) at the start of words. Where no piece has a marker after another
character, no merge crosses from a word into the next marker, so the segmentation of a text is the concatenation of the
segmentations of its marked words (a run of markers and the characters up to the next one). Each distinct marked word is
segmented once and its ids are joined back by position.

The table of distinct words is kept by each task, and emptied when it holds `TABLE_WORDS` entries, so that its memory is
bounded. A table across all documents would have to be joined to every word position of the corpus, a shuffle of several
times the input; README has the figures.

Models for which the property does not hold are segmented text by text. Defined results: a null text is empty and has no
ids; rows are independent, so repeated rows give equal results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from .common import schema_with, split_rows

MARK = "▁"
MARKED_WORD = re.compile(f"[ {MARK}]([ {MARK}]*[^ {MARK}]*)")
TABLE_WORDS = 500_000
#: Words that are segmented in one call; each begins with the only piece that has a marker.
CALL_WORDS = 1000


def marked_words(text: str) -> list[str]:
    """The marked words of a text, each without its first marker."""
    if "  " in text or MARK in text or text[:1] in ("", " ") or text[-1] == " ":
        return MARKED_WORD.findall(" " + text) if text else []
    return text.split(" ")


class Codec:
    """Encodes and decodes whole texts as the library does, by way of distinct marked words.

    The table has, by word without its first marker, the ids as packed numbers and as decimal text.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.starts = np.array([p.startswith(MARK) for p in pieces])
        self.mark = self.model.piece_to_id(MARK)
        self.by_word = not any(MARK in p.lstrip(MARK) for p in pieces) and self.model.decode(self.model.encode(" a  b ")) == " a  b " and self.mark != self.model.unk_id()
        self.ids: dict[str, bytes] = {}
        self.names: dict[str, str] = {}

    def _put(self, word: str, ids: list[int]) -> None:
        self.ids[word] = np.array(ids, np.int32).tobytes()
        self.names[word] = ",".join(map(str, ids))

    def _learn(self, words: set[str]) -> None:
        missing = words.difference(self.ids)
        if len(self.ids) + len(missing) > TABLE_WORDS:
            self.ids.clear()
            self.names.clear()
            missing = words
        odd = [w for w in missing if not w or " " in w or MARK in w]
        for word, ids in zip(odd, self.model.encode(odd, num_threads=1) if odd else [], strict=True):
            self._put(word, ids or [self.mark])
        plain = list(missing.difference(odd))
        groups = [plain[i : i + CALL_WORDS] for i in range(0, len(plain), CALL_WORDS)]
        for group, ids in zip(groups, self.model.encode([" ".join(g) for g in groups], num_threads=1) if groups else [], strict=True):
            packed = np.array(ids, np.int32)
            at = np.flatnonzero(self.starts[packed])
            if len(at) != len(group):
                for word, own in zip(group, self.model.encode(group, num_threads=1), strict=True):
                    self._put(word, own)
                continue
            raw, cuts, text = packed.tobytes(), [*at.tolist(), len(ids)], list(map(str, ids))
            for k, word in enumerate(group):
                self.ids[word] = raw[4 * cuts[k] : 4 * cuts[k + 1]]
                self.names[word] = ",".join(text[cuts[k] : cuts[k + 1]])

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[str]]:
        """The ids of each text, and the same as decimal numbers joined by commas."""
        if not self.by_word:
            ids = self.model.encode(texts, num_threads=1)
            return ids, [",".join(map(str, x)) for x in ids]
        split = list(map(marked_words, texts))
        self._learn(set().union(*split))
        ids = [np.frombuffer(b"".join(map(self.ids.__getitem__, words)), np.int32).tolist() for words in split]
        return ids, [",".join(map(self.names.__getitem__, words)) for words in split]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.model.decode(ids, num_threads=1) if ids else []


def _with_codec(df: DataFrame, path: str, schema: StructType, column: str, row: Callable[[Codec, pa.RecordBatch], dict[str, pa.Array]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in split_rows(batches, column) if column == "text" else batches:
            codec = codec or Codec(path)
            yield pa.RecordBatch.from_pydict(row(codec, batch))

    return df.mapInArrow(run, schema)


def _texts(batch: pa.RecordBatch) -> list[str]:
    return pc.fill_null(batch.column("text"), "").to_pylist()


def encode(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """docs' `keep` columns with ids (array of int) and n_tokens."""

    def row(codec: Codec, batch: pa.RecordBatch) -> dict[str, pa.Array]:
        ids, _ = codec.encode(_texts(batch))
        return {c: batch.column(c) for c in keep} | {"ids": pa.array(ids, pa.list_(pa.int32())), "n_tokens": pa.array([len(x) for x in ids], pa.int64())}

    return _with_codec(docs.select(*keep, "text"), path, schema_with(docs, keep, "ids array<int>, n_tokens bigint"), "text", row)


def decode(encoded: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """encoded's `keep` columns with text, decoded from ids."""

    def row(codec: Codec, batch: pa.RecordBatch) -> dict[str, pa.Array]:
        ids = [x or [] for x in batch.column("ids").to_pylist()]
        return {c: batch.column(c) for c in keep} | {"text": pa.array(codec.decode(ids), pa.string())}

    return _with_codec(encoded.select(*keep, "ids"), path, schema_with(encoded, keep, "text string"), "ids", row)


def digests(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """docs' `keep` columns with n_tokens, ids_sha256 and decoded_sha256 (and ids): texts encoded and decoded again in one pass without a shuffle."""

    def row(codec: Codec, batch: pa.RecordBatch) -> dict[str, pa.Array]:
        ids, names = codec.encode(_texts(batch))
        sha = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()
        made = {
            "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
            "ids_sha256": pa.array(map(sha, names), pa.string()),
            "decoded_sha256": pa.array(map(sha, codec.decode(ids)), pa.string()),
        }
        return {c: batch.column(c) for c in keep} | made | ({"ids": pa.array(ids, pa.list_(pa.int32()))} if with_ids else {})

    more = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return _with_codec(docs.select(*keep, "text"), path, schema_with(docs, keep, more), "text", row)
