"""Byte-level BPE encoding and decoding by the tiktoken library with a local rank file.

A text over PIECE characters is cut at safe places (before a single space between two other
characters, where no match of the pattern can span), so that one call never holds a very long text.
decode() returns raw bytes: ids may end inside a character.

Null is the empty text: no ids, the hashes of nothing. Repeated rows are encoded one by one, alike.
Only doc_id and text are read; other columns of the input don't come out. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from leafmill.llm.tokenizing import PIECE, safe_pieces, tiktoken_encoding, vocabulary


class Bpe:
    def __init__(self, ranks: str | None = None, piece: int = PIECE):
        self.encoding, self.piece = tiktoken_encoding(ranks or vocabulary("byte_bpe_50k.tiktoken")), piece

    def encode(self, text: str | None) -> list[int]:
        text = text or ""
        if len(text) <= self.piece:
            return self.encoding.encode_ordinary(text)
        return [i for p in safe_pieces(text, self.piece) for i in self.encoding.encode_ordinary(p)]

    def decode(self, ids: list[int]) -> bytes:
        return self.encoding.decode_bytes(ids)


def encode_ids(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """doc_id and ids (array of int) of every text."""
    path = ranks or vocabulary("byte_bpe_50k.tiktoken")

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(path)
        for batch in rows:
            ids = pa.array([bpe.encode(t) for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return docs.selectExpr("doc_id", "cast(text as string) as text").mapInArrow(run, "doc_id bigint, ids array<int>")


def digest_ids(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of every text: the ids are encoded, decoded again and hashed in place."""
    path = ranks or vocabulary("byte_bpe_50k.tiktoken")

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(path)
        decimal = [str(i) for i in range(bpe.encoding.n_vocab)]
        for batch in rows:
            counts, hashes, decoded = [], [], []
            for text in batch.column(1):
                ids = bpe.encode(text.as_py())
                counts.append(len(ids))
                hashes.append(hashlib.sha256(" ".join([decimal[i] for i in ids]).encode()).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.selectExpr("doc_id", "cast(text as string) as text").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
