"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import functools
import os
import re

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hex256, map_batches

#: Texts up to this many characters go to the library whole.
WHOLE = 1 << 16
#: A run of white space this long is a piece of its own: the library's regex recurses on it.
LONG_SPACE = 512
#: A rank file is broadcast; this bounds its size.
MAX_RANK_BYTES = 64 << 20

_SPACE = "[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
_LONG_RUN = re.compile(_SPACE + "{%d,}" % LONG_SPACE)
#: The pre-split pattern never matches across the place between a word or mark and a blank or line end.
_SAFE = re.compile(r"(?<=[0-9A-Za-z.,;:!?])(?=[ \n])")


class Codec:
    """Encoding by ranks; each match of the pattern is merged by itself, no special tokens."""

    def __init__(self, rank_file: bytes, pattern: str):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines()) if a}
        self.encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        """Token ids of the whole text. Long texts are cut at places where the pattern always cuts."""
        if len(text) <= LONG_SPACE:
            return self.encoding.encode_ordinary(text)
        ids: list[int] = []
        at = 0
        for run in _LONG_RUN.finditer(text):
            # The pattern takes all of a run but its last character, or all of it at the end of the text.
            end = run.end() if run.end() == len(text) else run.end() - 1
            ids += self._segments(text[at : run.start()])
            ids += self.encoding._encode_single_piece(text[run.start() : end])
            at = end
        return ids + self._segments(text[at:])

    def _segments(self, text: str) -> list[int]:
        if len(text) <= WHOLE:
            return self.encoding.encode_ordinary(text)
        ids: list[int] = []
        at = 0
        while len(text) - at > WHOLE and (cut := _SAFE.search(text, at + WHOLE)):
            ids += self.encoding.encode_ordinary(text[at : cut.start()])
            at = cut.start()
        return ids + self.encoding.encode_ordinary(text[at:])

    def decode(self, ids: list[int]) -> bytes:
        """Raw bytes: ids may end inside a character."""
        return self.encoding.decode_bytes(ids)


def read_rank_file(spark: SparkSession, path: str) -> bytes:
    """The rank file's bytes, from the driver's disk or any store that Spark reads; its size is checked."""
    if os.path.exists(path):
        data = open(path, "rb").read() if os.path.getsize(path) <= MAX_RANK_BYTES else b"\0" * (MAX_RANK_BYTES + 1)
    else:
        data = bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    if len(data) > MAX_RANK_BYTES:
        raise ValueError(f"rank file over {MAX_RANK_BYTES} bytes: {path}")
    return data


@functools.lru_cache(maxsize=4)
def _codec(rank_file: bytes, pattern: str) -> Codec:
    return Codec(rank_file, pattern)


def encode(docs: DataFrame, rank_path: str, pattern: str, text: str = "text", into: str = "ids") -> DataFrame:
    """docs with the token ids of every whole text in column ``into`` (replaced if it is there).

    Null and empty texts have no ids. Rows, repeats included, keep their columns. Map-only.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_rank_file(docs.sparkSession, rank_path))
    kept = [c for c in docs.columns if c.lower() != into.lower() or c == text]
    source = docs.select(*kept)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = _codec(shared.value, pattern)
        ids = [codec.encode(t or "") for t in batch.column(text).to_pylist()]
        columns = {c: batch.column(c) for c in batch.schema.names if c != into}
        return pa.RecordBatch.from_pydict(columns | {into: pa.array(ids, pa.list_(pa.int32()))})

    fields = [f for f in source.schema.fields if f.name != into]
    schema = T.StructType(fields).add(into, T.ArrayType(T.IntegerType()))
    return source.mapInArrow(_batched(run), schema)


def decode(frame: DataFrame, rank_path: str, pattern: str, ids: str = "ids", into: str = "bytes") -> DataFrame:
    """frame with the raw bytes of the token ids in column ``into``; null ids give null, no ids give none."""
    shared = frame.sparkSession.sparkContext.broadcast(read_rank_file(frame.sparkSession, rank_path))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = _codec(shared.value, pattern)
        out = [None if x is None else codec.decode(x) for x in batch.column(ids).to_pylist()]
        columns = {c: batch.column(c) for c in batch.schema.names if c != into}
        return pa.RecordBatch.from_pydict(columns | {into: pa.array(out, pa.binary())})

    fields = [f for f in frame.schema.fields if f.name != into]
    schema = T.StructType(fields).add(into, T.BinaryType())
    return frame.mapInArrow(_batched(run), schema)


def _batched(fn):
    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                yield fn(batch.slice(start, 256))

    return run


def round_trip(docs: DataFrame, rank_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text: encoded, then decoded from the ids.

    Null texts count as empty: no tokens, both digests of the empty string. Repeated rows and null
    keys keep their rows. Other columns are dropped, so their names can't clash. One map over the
    table without a shuffle; a task holds 256 texts at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_rank_file(docs.sparkSession, rank_path))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = _codec(shared.value, pattern)
        n, digests, decoded = [], [], []
        for value in batch.column(1).to_pylist():
            ids = codec.encode(value or "")
            n.append(len(ids))
            digests.append(hex256(" ".join(map(str, ids)).encode()))
            decoded.append(hex256(codec.decode(ids)))
        return pa.RecordBatch.from_pydict(
            {"doc_id": batch.column(0), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": digests, "decoded_sha256": decoded}
        )

    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(source, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
