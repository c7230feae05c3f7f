"""The retrieval index: documents as text, cut into overlapping chunks with stable ids."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ids import content_hash, joined_id
from ..functions.text import path_name, path_stem
from .relational import grouping_counts

#: Nested items of a list that are expanded; the rest are counted.
EXPANDED = 120
DEPTH = 5


def scalar_text(value) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, str):
        return value.strip()
    return str(value) if isinstance(value, int | float) else ""


def flattened(value, path: str = "", depth: int = 0) -> Iterator[str]:
    """Lines 'path: value' of a JSON value, keys sorted; scalars of a list on one line."""

    def put(name: str, text: str) -> str:
        return f"{name}: {text}" if name else text

    text = scalar_text(value)
    if depth > DEPTH:
        yield put(path, json.dumps(value, ensure_ascii=False, sort_keys=True))
    elif text:
        yield put(path, text)
    elif isinstance(value, dict):
        for key in sorted(value, key=str):
            yield from flattened(value[key], f"{path}.{key}" if path else str(key), depth + 1)
    elif isinstance(value, list):
        plain = [t for t in map(scalar_text, value) if t]
        nested = [v for v in value if not scalar_text(v)]
        if plain:
            yield put(path or "items", ", ".join(plain))
        for i, v in enumerate(nested[:EXPANDED]):
            yield from flattened(v, f"{path or 'item'}[{i}]", depth + 1)
        if len(nested) > EXPANDED:
            yield put(path or "items", f"... {len(nested) - EXPANDED} more complex items not expanded")
    else:
        yield put(path, json.dumps(value, ensure_ascii=False, sort_keys=True))


@F.pandas_udf(T.StringType())
def flattened_udf(doc: pd.Series, path: pd.Series) -> pd.Series:
    """Arrow: recursion over JSON of unknown shape. Null and invalid JSON give null."""

    def one(text, name):
        try:
            value = json.loads(text) if text else None
        except ValueError:
            return None
        return None if value is None else "\n".join(flattened(value, name))

    return pd.Series([one(t, n) for t, n in zip(doc, path, strict=True)])


def document_text(docs: DataFrame) -> DataFrame:
    """docs(program, type, title, embedding_text, content, meta, evidence) with text: the envelope as labelled paragraphs."""
    from ..functions.text import compact_lines

    flat = lambda c, name: F.nullif(flattened_udf(F.col(c), F.lit(name)), F.lit(""))
    title = F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.concat_ws(" ", "program", "type"))
    rows = docs.withColumn("title", title).withColumn("__content", flat("content", "content")).withColumn("__meta", flat("meta", "meta")).withColumn("__evidence", F.nullif(F.array_join("evidence", ", "), F.lit("")))
    label = lambda name, c: F.concat(F.lit(name), F.nullif(F.trim(c), F.lit("")))
    parts = [
        label("Program: ", "program"), label("Type: ", "type"), label("Title: ", "title"), label("Embedding: ", "embedding_text"), F.concat(F.lit("Content:\n"), "__content"),
        F.concat(F.lit("Metadata:\n"), "__meta"), F.concat(F.lit("Evidence:\nevidence: "), "__evidence"),
    ]
    return rows.withColumn("text", compact_lines(F.concat_ws("\n\n", *parts))).drop("__content", "__meta", "__evidence")


def fixed_spans(n: Column, size: int, overlap: int) -> Column:
    """Array of (start, end) from 0: closed form, no loop. Nothing for n = 0."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")
    last = F.when(n <= size, 0).otherwise(F.ceil((n - size) / F.lit(size - overlap)).cast("int"))
    spans = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct((i * (size - overlap)).cast("int").alias("start"), F.least(i * (size - overlap) + size, n).cast("int").alias("end")))
    return F.when(n > 0, spans).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def fixed_chunks(docs: DataFrame, key: str, text: str, size: int, overlap: int) -> DataFrame:
    """key, chunk_index, chunk_count, chunk: characters cut at fixed places. Null and empty texts have none. Native, map-only.

    A text is cut into steps in one pass and each step completed from the next: time grows with the text's length,
    and no chunk carries the whole text. (Where the overlap is longer than a step, chunks are cut one by one.)
    """
    step = size - overlap
    n = F.size(fixed_spans(F.length(text), size, overlap)).cast("int")
    if overlap > step:
        rows = docs.select(key, text, n.alias("chunk_count"), F.posexplode(fixed_spans(F.length(text), size, overlap)).alias("chunk_index", "span"))
        return rows.select(key, "chunk_index", "chunk_count", F.substr(text, F.col("span.start") + 1, F.col("span.end") - F.col("span.start")).alias("chunk"))
    rows = docs.select(key, n.alias("chunk_count"), F.regexp_extract_all(text, F.lit(f"(?s)(.{{1,{step}}})"), 1).alias("steps"))
    whole = F.zip_with("steps", F.slice("steps", 2, 1 << 30), lambda a, b: F.concat(a, F.coalesce(F.substring(b, 1, overlap), F.lit(""))))
    return rows.select(key, "chunk_count", F.posexplode(F.slice(whole, F.lit(1), F.col("chunk_count"))).alias("chunk_index", "chunk")).select(key, "chunk_index", "chunk_count", "chunk")


def soft_spans(text: str, size: int, overlap: int) -> list[str]:
    """Chunks that end, where they can, at a line end or after a sentence in their last third; parts of no text are left out."""
    if size <= 0 or len(text) <= size:
        return [text]
    overlap = max(0, min(overlap, size // 3))
    out, at = [], 0
    while at < len(text):
        end = min(len(text), at + size)
        if end < len(text):
            soft = max(text.rfind(mark, at, end) for mark in ("\n", ". ", "; ")) - at
            end = at + soft + 1 if soft > size * 0.65 else end
        if piece := text[at:end].strip():
            out.append(piece)
        if end == len(text):
            break
        at = max(end - overlap, at + 1)
    return out


#: Bytes of text that are cut and sent back together; a longer text goes by itself.
PART_BYTES = 2 << 20


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """batch(key, text) in runs of rows of at most PART_BYTES of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PART_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def soft_chunks(docs: DataFrame, key: str, text: str, size: int = 6000, overlap: int = 600) -> DataFrame:
    """key, chunk_index, chunk_count, chunk. Where a chunk starts depends on where the one before ended: Arrow, one text at a time.

    Null texts have none. Other rows, repeats included, keep their chunks. Python holds a batch as it came (Spark ends one at
    spark.sql.execution.arrow.maxBytesPerBatch) and the chunks of one part of it, not those of the batch.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                pieces = [[] if t is None else soft_spans(t, size, overlap) for t in part.column(1).to_pylist()]
                rows = [(at, i, len(p), chunk) for at, p in enumerate(pieces) for i, chunk in enumerate(p)]
                at, index, count, chunk = zip(*rows, strict=True) if rows else ((), (), (), ())
                own = part.column(0).take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([own, pa.array(index, pa.int32()), pa.array(count, pa.int32()), pa.array(chunk, pa.string())], [key, "chunk_index", "chunk_count", "chunk"])

    rows = docs.select(key, F.col(text).alias("__text"))
    fields = [T.StructField("chunk_index", T.IntegerType()), T.StructField("chunk_count", T.IntegerType()), T.StructField("chunk", T.StringType())]
    return rows.mapInArrow(cut, T.StructType([rows.schema[key], *fields]))


ANCHOR = r"(?i)\bDIVISION\.\s*$|\bSECTION\.\s*$|^\s{0,8}[A-Z0-9][A-Z0-9-]*\.\s*$"


def anchor_spans(n: int, size: int, overlap: int, anchors: list[int]) -> list[tuple[int, int]]:
    """(start, end) of line chunks that end and start at anchors where one is near enough."""
    import bisect

    places = sorted({0, *(a for a in anchors if 0 <= a < n)})
    before = lambda at: places[bisect.bisect_right(places, at) - 1]
    least = max(20, int(size * 0.3))
    out, at, earlier = [], 0, -1
    while at < n:
        end = min(at + size, n)
        if before(end) > at + least:
            end = before(end)
        out.append((at, end))
        if end >= n:
            break
        earlier, at = at, max(end - overlap, at + 1)
        if before(at) > earlier:
            at = before(at)
    return out


def code_chunks(lines: DataFrame, size: int = 200, overlap: int = 20) -> DataFrame:
    """file, chunk_index, chunk_count, line_start, line_end, text of program lines(file, line_no, raw).

    Anchors are found by an expression; only their positions are walked (Arrow, one file's array).
    """
    from ..functions.text import without_sequence

    bare = without_sequence(F.col("raw"))
    comment = F.substring(bare, 7, 1).isin("*", "/") | F.startswith(F.ltrim(bare), F.lit("*"))
    anchor = F.when(~comment & F.rtrim(bare).rlike(ANCHOR), F.col("line_no") - 1)
    files = lines.groupBy("file").agg(F.max("line_no").alias("n"), F.array_sort(F.collect_list(anchor)).alias("anchors"), F.transform(F.array_sort(F.collect_list(F.struct("line_no", "raw"))), lambda x: x["raw"]).alias("held"))
    walk = F.pandas_udf(lambda n, a: pd.Series([[{"start": s, "end": e} for s, e in anchor_spans(int(k), size, overlap, list(x))] for k, x in zip(n, a, strict=True)]), "array<struct<start:int,end:int>>")
    spans = files.withColumn("spans", F.when(F.size("anchors") > 0, walk("n", "anchors")).otherwise(fixed_spans(F.col("n"), size, overlap)))
    rows = spans.select("file", "held", F.size("spans").alias("chunk_count"), F.posexplode("spans").alias("chunk_index", "s"))
    text = F.array_join(F.slice("held", F.col("s.start") + 1, F.col("s.end") - F.col("s.start")), "\n")
    return rows.select("file", "chunk_index", "chunk_count", (F.col("s.start") + 1).alias("line_start"), F.col("s.end").alias("line_end"), text.alias("text"))


def code_documents(chunks: DataFrame, programs: DataFrame) -> DataFrame:
    """Chunks of code as documents with id and content hash."""
    from ..functions.ids import text_sha1

    rows = chunks.join(programs, "file")
    ident = joined_id(F.col("program"), F.col("file"), F.col("line_start"), F.col("line_end"))
    return rows.select(ident.alias("id"), F.lit("code.chunk").alias("type"), "program", F.format_string("%s lines %d-%d", "program", "line_start", "line_end").alias("title"), "text", text_sha1(F.col("text")).alias("content_sha1"), "file", "chunk_index", "chunk_count", "line_start", "line_end")


def source_kind(path: Column) -> Column:
    """Of a document's path: its stem in the folders inputs and artifacts, else the folder's name."""
    folder = F.regexp_extract(path, r"([^/]+)/[^/]*$", 1)
    return F.when(folder.isin("inputs", "artifacts"), path_stem(path)).otherwise(folder)


def document_type(kind: Column, path: Column) -> Column:
    folder, given = F.regexp_extract(path, r"([^/]+)/[^/]*$", 1), F.nullif(F.trim(kind), F.lit(""))
    rag = (folder == "inputs") & (path_name(path) == "rag_documents.json")
    return F.when(given.isNull(), F.replace(source_kind(path), F.lit("_"), F.lit("."))).when(rag, F.concat(given, F.lit(".rag"))).otherwise(given)


def records(docs: DataFrame, size: int = 6000, overlap: int = 600) -> DataFrame:
    """Index records of docs(program, type, title, id, text, source_file, json_index): id, program, type, title, text, metadata."""
    rows = docs.withColumn("program", F.upper("program")).withColumn("__key", F.struct("program", "type", "title", "source_file", "json_index", F.coalesce("id", F.lit("")).alias("source_id")))
    cut = soft_chunks(rows, "__key", "text", size, overlap).select("__key.*", "chunk_index", "chunk_count", "chunk")
    ident = joined_id(*[F.col(c) for c in ("program", "source_file", "json_index", "source_id", "chunk_index")], sep="\n")
    meta = F.struct("program", "type", "title", "source_file", source_kind(F.col("source_file")).alias("source_kind"), "source_id", "json_index", "chunk_index", "chunk_count", content_hash(F.col("chunk")).alias("content_hash"))
    return cut.select(ident.alias("id"), "program", "type", "title", F.col("chunk").alias("text"), meta.alias("metadata"))


def manifest(records_: DataFrame) -> DataFrame:
    """Counts of records by program, by type and by both, in one pass: program, type, n, level."""
    return grouping_counts(records_, "program", "type")


def top_types(records_: DataFrame, k: int = 8) -> DataFrame:
    """program, type, n, rank: the k most frequent types of each program."""
    n = records_.groupBy("program", "type").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("rank", F.row_number().over(Window.partitionBy("program").orderBy(F.desc("n"), "type"))).where(F.col("rank") <= k)
