"""Encoding documents with a public vocabulary and decoding them back."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import bpe

_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id`` and ``ids``, the token ids of every whole text (``array<int>``; a null text has none).

    ``path`` is the vocabulary file on every executor, by default that of the installed package. One row per row of the
    input, repeated rows and null ids included; other columns are ignored.
    """
    def run(batches):
        tokenizer = bpe.load(path)
        for batch in batches:
            ids = [tokenizer.encode(t.as_py() or "").astype("int32") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))],
                                             names=["doc_id", "ids"])
    return _input(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id`` and ``text``: the surfaces of the ids, joined by blanks as the vocabulary names no decoder."""
    def run(batches):
        tokenizer = bpe.load(path)
        for batch in batches:
            texts = [tokenizer.decode(i.values.to_numpy()).decode() if i.is_valid else "" for i in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The digest of ``encode`` and ``decode`` in one pass: number of ids, and SHA-256 of ids and of decoded text.

    The same rows and edge cases as ``encode``; an empty or null text has no ids and decodes to the empty text.
    """
    def run(batches):
        tokenizer = bpe.load(path)
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for value in batch.column("text"):
                ids = tokenizer.encode(value.as_py() or "")
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(" ".join(map(str, ids.tolist())).encode()).hexdigest())
                text_sha.append(hashlib.sha256(tokenizer.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return _input(docs).mapInArrow(run, _SCHEMA)


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
