"""SimHash near-duplicates with pivot distance tables.

Fingerprints link at 3 or fewer differing bits. Pivot tables alone would compare every pair, since
distances between unrelated fingerprints concentrate at 32; so pairs are first brought together by
equal bit groups (of BLOCKS groups, 3 differing bits leave at least BLOCKS - 3 untouched). Within such
a bucket the fingerprints are sorted by their distance to the first pivot, only a band of difference 3
is looked at, and pairs whose coordinates differ by more than 3 at any pivot are discarded before the
survivors' Hamming distance is verified.

A bucket of more than MAX_BUCKET fingerprints, as a large group of near copies can fill, goes to no task as a whole.
Its fingerprints meet at points instead: of two at most 3 bits apart, one is within 1 and the other within 2 bits of
some point, so each is sent to all points within 2 of it. At most 2,081 fingerprints can be that near to a point,
whatever the bucket's size, and they link through one that is within 1 of it.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import as_bytes, checkpointed, map_batches, small, spread_join
from .components import components

SHINGLE = 3
MAX_DISTANCE = 3
BLOCKS = 5
N_PIVOTS = 16
#: Reference fingerprints: fixed, so that every task has the same table.
PIVOTS = np.random.default_rng(0x51A5).integers(0, 1 << 64, N_PIVOTS, np.uint64)
#: Rows of a bucket that are compared at once.
STRIP = 1024
#: Rows (an id and a hash) that keep_one broadcasts, at most; more are joined by a shuffle.
MAX_BROADCAST_ROWS = 2_000_000
#: Fingerprints of a bucket that one task compares, at most; larger buckets meet at points.
MAX_BUCKET = 16_384


def shingle_hashes(text: bytes | None, n: int = SHINGLE, seed: int = 42) -> np.ndarray:
    """XXH64 of every shingle of n words, repeats included; fewer words: of the whole sequence; none: none."""
    w = text.lower().split() if text else []
    if len(w) <= n:
        return np.array([xxh64_intdigest(b" ".join(w), seed)] if w else [], np.uint64)
    rows = zip(*(w[i:] for i in range(n)))
    return np.fromiter((xxh64_intdigest(b" ".join(r), seed) for r in rows), np.uint64, len(w) - n + 1)


def fingerprint(text: bytes | None, n: int = SHINGLE, seed: int = 42) -> int:
    """A bit is 1 if it is set in over half of the shingle hashes; zero without words."""
    h = shingle_hashes(text, n, seed)
    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):  # unpacked in strips: long texts need no more memory
        ones += np.unpackbits(h[i : i + (1 << 16)].astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long), text_hash of every whole text; null texts have no words, so zero."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([fingerprint(t) for t in as_bytes(batch.column(1))], np.uint64).view(np.int64)
        return pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "fp": pa.array(fp), "text_hash": batch.column(2)})

    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), _text_hash(text).alias("text_hash"))
    return map_batches(source, run, "doc_id long, fp long, text_hash long")


def _text_hash(text: str) -> F.Column:
    """Tells the texts of one doc_id apart; null has one of its own."""
    return F.xxhash64(F.col(text).cast("string"), F.col(text).isNull())


def _bit_groups(blocks: int) -> list[int]:
    """Masks of the bit groups: each way to choose blocks - MAX_DISTANCE of them."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    own = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(own, blocks - MAX_DISTANCE)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(fps: np.ndarray) -> np.ndarray:
    """A spanning forest of the links between distinct fingerprints: as many edges as connect them, no more.

    Each row of the pivot table holds a fingerprint's Hamming distances to the pivots. Rows are sorted by
    the first; by the triangle inequality a link lies within a band of MAX_DISTANCE there and at every
    other pivot, and only pairs inside all bands are verified.
    """
    n = len(fps)
    table = np.bitwise_count(fps[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    order = np.argsort(table[:, 0], kind="stable")
    fps, table = fps[order], table[order]
    ends = np.searchsorted(table[:, 0], table[:, 0] + MAX_DISTANCE, side="right")
    root = np.arange(n)
    edges = []
    for at in range(0, n, STRIP):
        stop = min(at + STRIP, n)
        for low in range(at, int(ends[stop - 1]), STRIP):
            high = min(low + STRIP, int(ends[stop - 1]))
            near = np.abs(table[at:stop, None, 1] - table[None, low:high, 1]) <= MAX_DISTANCE
            i, j = np.nonzero(near & (root[at:stop, None] != root[None, low:high]))
            i, j = i + at, j + low
            for p in (0, *range(2, N_PIVOTS)):
                if len(i) < 64:
                    break
                near = np.abs(table[i, p] - table[j, p]) <= MAX_DISTANCE
                i, j = i[near], j[near]
            linked = np.bitwise_count(fps[i] ^ fps[j]) <= MAX_DISTANCE
            i, j = i[linked], j[linked]
            while len(i):
                # Every larger root hooks to one smaller root: one edge each, never a cycle.
                larger, first = np.unique(np.maximum(root[i], root[j]), return_index=True)
                edges.append(np.stack([fps[i[first]], fps[j[first]]], 1))
                root[larger] = np.minimum(root[i], root[j])[first]
                while not np.array_equal(root, up := root[root]):
                    root = up
                apart = root[i] != root[j]
                i, j = i[apart], j[apart]
    return np.concatenate(edges) if edges else np.zeros((0, 2), np.uint64)


def _meeting_points(dense: DataFrame, masks: list[int]) -> DataFrame:
    """a, b: the same for dense(fp, mask), fingerprints whose bits under the mask many others share.

    Two of one bucket differ outside the mask only, so only those bits are flipped: 781 points at most. A point's
    rows are bounded, so the list of one is too.
    """
    rows = []
    for i, mask in enumerate(masks):
        free = [b for b in range(64) if not mask >> b & 1]
        rows.append((i, 0, 0))
        rows += [(i, _signed(1 << a), 1) for a in free]
        rows += [(i, _signed(1 << a | 1 << b), 2) for a, b in combinations(free, 2)]
    flips = dense.sparkSession.createDataFrame(rows, "mask int, flip long, d int")  # under 10,000 rows for any input
    points = dense.join(F.broadcast(flips), "mask").select(F.col("fp").bitwiseXOR(F.col("flip")).alias("point"), "fp", "d").distinct()
    near = points.groupBy("point").agg(F.min("d").alias("d"), F.min_by("fp", F.struct("d", "fp")).alias("hub"), F.collect_set("fp").alias("fps"))
    met = near.where("d <= 1 AND size(fps) > 1").select(F.col("hub").alias("a"), F.explode("fps").alias("b"))
    return met.where("a <> b").distinct()


def links(fps: DataFrame, blocks: int = BLOCKS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """a, b: edges that connect all fingerprints of fps(fp, distinct) that links of 3 or fewer bits connect.

    Fingerprints meet under every choice of equal bit groups (for 5 blocks, ten keys of 25 or 26 bits).
    A bucket gives a spanning forest, so its rows grow with the bucket, not with its square.
    """
    masks = _bit_groups(blocks)
    keyed = fps.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("mask", "bits"),
    )
    # Only buckets of two or more go to Python, and none beyond the bound.
    size = checkpointed(keyed.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    shared = keyed.join(size.where(F.col("n") <= max_bucket).select("mask", "bits"), ["mask", "bits"], "left_semi")

    def run(key: tuple, bucket: pa.Table) -> pa.Table:
        edges = forest(bucket.column("fp").to_numpy().view(np.uint64))
        out = np.ascontiguousarray(edges.T).view(np.int64)
        return pa.Table.from_pydict({"a": out[0], "b": out[1]})

    edges = shared.groupBy("mask", "bits").applyInArrow(run, "a long, b long")
    large = size.where(F.col("n") > max_bucket).select("mask", "bits")
    if large.isEmpty():
        return edges
    dense = keyed.join(large, ["mask", "bits"], "left_semi").select("fp", "mask")
    return edges.union(_meeting_points(dense, masks))


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", blocks: int = BLOCKS) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id of every row of docs.

    component_id is the smallest doc_id that links of 3 or fewer differing bits reach, itself included.
    Texts without words (null, empty, blank) have fingerprint zero and link like any other. Repeated rows
    keep their rows; a null doc_id keeps its row and is never the smallest unless its component has no other
    (then component_id is null). Copies meet once, as one fingerprint, before any bucket.
    """
    return _grouped(docs, key, text, blocks).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def _grouped(docs: DataFrame, key: str, text: str, blocks: int, per: int | None = None) -> DataFrame:
    """doc_id, fp, text_hash, component_id and kept of every row of docs.

    kept: (no id, doc_id, text_hash) of the row that stays of the component, its smallest. A fingerprint of very many
    rows, such as that of all empty texts, and a component of very many fingerprints are dealt to several tasks.
    """
    marked = checkpointed(fingerprints(docs, key, text))
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    classes = checkpointed(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.min(own).alias("first"), F.count(F.lit(1)).alias("n")))
    roots = components(links(classes.select("fp"), blocks))
    joined = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "least", "first", "n", F.coalesce("root", "fp").alias("root"))
    joined = checkpointed(joined)
    smallest = joined.groupBy("root").agg(F.min("least").alias("component_id"), F.min("first").alias("kept"), F.count(F.lit(1)).alias("fps"))
    named = spread_join(joined, smallest, "root", F.xxhash64("fp"), "fps", per).select("fp", "n", "component_id", "kept")
    return spread_join(marked, named, "fp", F.xxhash64("doc_id", "text_hash"), "n", per)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", blocks: int = BLOCKS, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """docs with one row of each near-duplicate group: that of the smallest doc_id. Columns stay as they are.

    Where that doc_id repeats in the group, the text with the smallest hash stays; of rows that repeat id and text, the
    one whose columns together hash lowest. Rows without a doc_id come after all others of their group, and one stays
    only of a group that has nothing else. Empty and null texts are a group, as in groups(). No rows: none.

    Texts stay where they are: who goes is found by id and hash, and that list is broadcast if it is small. Only rows
    that repeat are shuffled whole.
    """
    rows = checkpointed(_grouped(docs, key, text, blocks).select("doc_id", "text_hash", "kept"))
    stays = F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("text_hash") == F.col("kept.text_hash"))
    pair = ["doc_id", "text_hash"]
    gone = rows.where(~stays).select(*pair).distinct()
    again = checkpointed(rows.where(stays).groupBy(*pair).count().where("count > 1").select(*pair))
    name = _unused(docs, "__hash")
    named = docs.withColumn(name, _text_hash(text))
    same = lambda other: named[key].cast("long").eqNullSafe(other["doc_id"]) & (named[name] == other["text_hash"])
    out = gone.unionByName(again)
    out = small(checkpointed(out), max_rows)
    left = named.join(out, same(out), "left_anti").select(*docs.columns)
    if again.isEmpty():
        return left
    again = small(again, max_rows)
    repeated = named.join(again, same(again), "left_semi")
    whole = F.xxhash64(*[F.col(c) for c in docs.columns])
    once = repeated.groupBy(key, name).agg(F.min_by(F.struct(*docs.columns), whole).alias("row"))
    return left.unionByName(once.select(*[F.col("row")[c].alias(c) for c in docs.columns]))


def _unused(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name
