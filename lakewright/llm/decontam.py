"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned over training token windows.

A benchmark of more windows than one set holds is scanned in passes, one after another: each pass's result is written
before the next set is built, so that driver and executors hold one set at a time, however large the benchmark is.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, checkpointed, map_batches, slices, word_places, words, written

N_GRAM = 10
#: Windows in one broadcast. Larger benchmarks are scanned in several passes, each over all documents.
MAX_BROADCAST_WINDOWS = 500_000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class WindowSet:
    """A hash set of word windows with the items that hold them."""

    def __init__(self, windows: dict[tuple[bytes, ...], set]):
        self.windows = windows
        self.word_ids: dict[bytes, int] = {}
        for window in windows:
            for word in window:
                self.word_ids.setdefault(word, len(self.word_ids) + 1)
        hashes: dict[int, set[int]] = defaultdict(set)
        for window in windows:
            ids = np.array([self.word_ids[w] for w in window], np.uint64)
            hashes[len(window)].add(int(_rolling(ids, len(window))[0]))
        self.hashes = {n: np.array(sorted(h), np.uint64) for n, h in hashes.items()}

    def scan(self, tokens: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Spans (start, end) of words that windows cover, merged, and the items whose windows occur."""
        spans: list[tuple[int, int]] = []
        items: set = set()
        get = self.word_ids.get
        ids = np.fromiter(map(get, tokens, repeat(0)), np.uint64, len(tokens))
        known = ids != 0
        for n, hashes in self.hashes.items():
            if len(tokens) < n:
                continue
            # Starts of n known words in a row: the running count of unknown words doesn't change.
            unknown = np.concatenate(([0], np.cumsum(~known)))
            starts = np.flatnonzero(unknown[n:] == unknown[:-n])
            if not len(starts):
                continue
            found = _rolling_at(ids, starts, n)
            place = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
            for start in starts[hashes[place] == found].tolist():
                held = self.windows.get(tuple(tokens[start : start + n]))
                if held is not None:  # a hash hit is verified on its words
                    items |= held
                    spans.append((start, start + n))
        return merge(spans), items


def _rolling_at(ids: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(len(starts), np.uint64)
    for k in range(n):
        out = out * _MULTIPLIER + ids[starts + k]
    return out


def _rolling(ids: np.ndarray, n: int) -> np.ndarray:
    return _rolling_at(ids, np.arange(len(ids) - n + 1), n)


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def benchmark_windows(benchmark: DataFrame, n: int = N_GRAM, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (window, item_id): n consecutive words space-joined; a shorter item, but not none, is one window."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, windows = [], []
        for item_id, value in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
            w = words(value)
            for window in {b" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else ():
                ids.append(item_id)
                windows.append(window.decode())
        return pa.RecordBatch.from_pydict({"item_id": pa.array(ids, pa.string()), "window": pa.array(windows, pa.string())})

    source = benchmark.select(F.col(item).cast("string").alias("item_id"), F.col(text).cast("string").alias("text"))
    return map_batches(source, run, "item_id string, window string").distinct()


def window_sets(benchmark: DataFrame, n: int = N_GRAM, max_windows: int = MAX_BROADCAST_WINDOWS, item: str = "item_id", text: str = "text"):
    """(WindowSet, whether it is the last), of at most about max_windows rows each, that together hold every window.

    The windows are counted first; each window goes to one of as many parts as the bound asks for. A set is built when
    it is asked for.
    """
    rows = checkpointed(benchmark_windows(benchmark, n, item, text))
    total = rows.count()
    parts = max(1, -(-total * 5 // (4 * max_windows))) if total > max_windows else 1
    for part in range(parts):
        own = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("window"), F.lit(parts)) == part)
        windows: dict[tuple[bytes, ...], set] = {}
        for row in own.toLocalIterator():
            held = windows.setdefault(tuple(row.window.encode().split(b" ")), set())
            if row.item_id is not None:
                held.add(row.item_id)
        yield WindowSet(windows), part + 1 == parts


def _in_passes(frame: DataFrame, sets, scan: Callable[[DataFrame, Broadcast, bool, bool], DataFrame]) -> DataFrame:
    """scan(frame, set, first, last) for one set after another; a pass before the last is written and its set let go."""
    context, first = frame.sparkSession.sparkContext, True
    for one, last in sets:
        shared = context.broadcast(one)
        del one
        frame = scan(frame, shared, first, last)
        if not last:
            frame = written(frame, "decontamination")
            shared.destroy()
        first = False
    return frame


def find_hits(
    docs: DataFrame, benchmark: DataFrame, n: int = N_GRAM, max_windows: int = MAX_BROADCAST_WINDOWS,
    key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """doc_id, n_words, spans (array of start and end word), items (sorted strings) of every document.

    A document word inside any occurrence of a window is in a span. Null and empty texts have no words.
    Rows with equal keys keep their rows. Items with a null id mark words but have no name to report;
    items that share an id count once. No benchmark: no spans. Within the bound the scan is a map
    without a shuffle; a larger benchmark is scanned in passes whose arrays are concatenated in place,
    so no pass needs a join.
    """
    between = "doc_id long, text string, spans array<struct<start:int,end:int>>, items array<string>"
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    scan = lambda frame, shared, first, last: map_batches(frame, _scanner(shared, last, first), _HITS if last else between)
    return _in_passes(source, window_sets(benchmark, n, max_windows, item, item_text), scan)


_HITS = "doc_id long, n_words long, spans array<struct<start:int,end:int>>, items array<string>"
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _scanner(shared, last: bool, first: bool):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, n_words, spans, items = as_bytes(batch.column(1)), [], [], []
        earlier = [None] * batch.num_rows if first else zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
        for text, before in zip(texts, earlier, strict=True):
            tokens = words(text)
            found, held = shared.value.scan(tokens)
            if before is not None:
                found = merge([(s["start"], s["end"]) for s in before[0]] + found)
                held = held | set(before[1])
            n_words.append(len(tokens))
            spans.append([{"start": a, "end": b} for a, b in found])
            items.append(sorted(held))
        out = {"doc_id": batch.column(0)} | ({"n_words": pa.array(n_words, pa.int64())} if last else {"text": batch.column(1)})
        return pa.RecordBatch.from_pydict(out | {"spans": pa.array(spans, _SPAN), "items": pa.array(items, pa.list_(pa.string()))})

    return run


def report(docs: DataFrame, benchmark: DataFrame, n: int = N_GRAM, max_windows: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated; see find_hits for what each case gives."""
    hits = find_hits(docs, benchmark, n, max_windows)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["start"]))
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, remove: str = "documents", n: int = N_GRAM,
    max_windows: int = MAX_BROADCAST_WINDOWS, text: str = "text",
) -> DataFrame:
    """docs without their contaminated documents, or (remove="spans") with the hit words cut from the text.

    Cut text runs from the first to the last hit word of a span; white space round it stays. All columns
    of docs are kept as they are. The decision is made where the row is, so nothing is joined or shuffled.
    Null and empty texts have no words and stay; very long ones are read whole; repeated rows and rows without
    a doc_id are each judged by themselves. No benchmark: docs as they are. No docs: none.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(remove)
    sets = window_sets(benchmark, n, max_windows)
    if remove == "documents":
        return _in_passes(docs, sets, lambda frame, shared, first, last: frame.mapInArrow(_dropper(shared, text), docs.schema))
    # Every pass marks words of the uncut text; the last cuts what all have marked.
    mark = "__spans"
    while mark in docs.columns:
        mark += "_"
    marked = T.StructType([*docs.schema.fields, T.StructField(mark, T.ArrayType(T.ArrayType(T.IntegerType())))])
    scan = lambda frame, shared, first, last: frame.mapInArrow(_cutter(shared, text, mark, last), docs.schema if last else marked)
    return _in_passes(docs, sets, scan)


def _dropper(shared, text: str):
    def run(batches):
        for part in (p for batch in batches for p in slices(batch)):
            found = [shared.value.scan(words(v))[0] for v in as_bytes(part.column(part.schema.get_field_index(text)))]
            yield part.filter(pa.array([not f for f in found], pa.bool_()))

    return run


def _cutter(shared, text: str, mark: str, last: bool):
    def run(batches):
        for part in (p for batch in batches for p in slices(batch)):
            column = part.schema.get_field_index(text)
            values = as_bytes(part.column(column))
            found = [shared.value.scan(words(v))[0] for v in values]
            if mark in part.schema.names:
                before = part.column(part.schema.get_field_index(mark)).to_pylist()
                found = [merge([*map(tuple, b), *f]) for b, f in zip(before, found, strict=True)]
                part = part.select([c for c in part.schema.names if c != mark])
            if not last:
                yield part.append_column(mark, pa.array([[list(s) for s in f] for f in found], pa.list_(pa.list_(pa.int32()))))
            elif any(found):
                cut = [_without(v, f) if f else v for v, f in zip(values, found, strict=True)]
                yield part.set_column(column, part.schema.field(column), pa.array(cut, pa.binary()).cast(part.schema.field(column).type))
            else:
                yield part

    return run


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    places = word_places(text)
    out, at = [], 0
    for start, end in spans:
        out.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return b"".join([*out, text[at:]])
