"""SentencePiece-style encoding and decoding by shared-prefix Viterbi (operator 10).

The distinct marked words of a batch are sorted, which lays out their trie depth-first;
a word reuses the forward scores of the prefix that it shares with the one before it.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm._util import id_type, slices, strings
from strata.llm.lattice import MARK, Vocabulary, Walk, marked_words

ROWS = 2048
STORED = 400_000      # encoded words that a task keeps
_LONG = 64


class Codec:
    def __init__(self, path: str) -> None:
        self.vocabulary = Vocabulary(path)
        self._stored: dict[str, bytes] = {}
        self._text = [(MARK + "?" if i == self.vocabulary.unknown_id else p).encode()
                      for i, p in enumerate(self.vocabulary.pieces)]
        for i, b in self.vocabulary.byte_of.items():
            self._text[i] = bytes([b])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        split, stored = [marked_words(t) for t in texts], self._stored
        if len(stored) > STORED:
            stored.clear()
        new = {w for words in split for w in words if w not in stored}
        stored.update((w[1:], array("I", ids).tobytes())
                      for w, ids in Walk(self.vocabulary).ids(MARK + w for w in new))
        out = [b"".join(map(stored.__getitem__, words)) for words in split]
        for w in new:
            if len(w) > _LONG:
                del stored[w]
        return out

    def decode(self, ids: bytes) -> str:
        text = b"".join(map(self._text.__getitem__, array("I", ids))).decode("utf-8", "replace")
        return text.replace(MARK, " ")[1:]


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in slices(batches, ROWS):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(codec.encode(strings(batch.column("text"))), pa.binary())],
                ["doc_id", "ids"])
    return run


def _decoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in slices(batches, ROWS):
            texts = [None if i is None else codec.decode(i) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             ["doc_id", "text"])
    return run


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, ids (little-endian unsigned 32-bit, as binary).

    ``model`` is the path of a SentencePiece file, on every executor; its pieces and
    scores are read as a unigram model: the likeliest segmentation wins (ties: the longer
    last piece), and characters without a piece become bytes. Spaces are marks and one
    mark goes in front, as the file's own rules have it. A null or empty text has no ids.
    Ids of documents may be null and rows may repeat; an empty table gives an empty result.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return base.mapInArrow(_encoded(model), f"doc_id {id_type(docs, id_col)}, ids binary")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of ``encode``'s rows: the text itself, but a literal mark is a space.

    A null text was encoded as an empty one and comes back empty.
    """
    return encoded.mapInArrow(_decoded(model), f"doc_id {id_type(encoded, 'doc_id')}, text string")


def digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_crc32, decoded_crc32, round_trip.

    Encodes, decodes and compares in one pass, so neither ids nor texts are moved.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model)
        for batch in slices(batches, ROWS):
            texts = strings(batch.column("text"))
            ids = codec.encode(texts)
            back = [codec.decode(i) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()),
                 pa.array(map(zlib.crc32, ids), pa.int64()),
                 pa.array([zlib.crc32(b.encode()) for b in back], pa.int64()),
                 pa.array([b == t.replace(MARK, " ") for b, t in zip(back, texts)], pa.bool_())],
                ["doc_id", "n_tokens", "ids_crc32", "decoded_crc32", "round_trip"])
    return base.mapInArrow(run, f"doc_id {id_type(docs, id_col)}, n_tokens long, ids_crc32 long, "
                                "decoded_crc32 long, round_trip boolean")
