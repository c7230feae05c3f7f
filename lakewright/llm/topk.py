"""Exact top-k inner-product search with a three-phase uniform threshold.

A vector's components are dealt to LISTS lists (slices of the dimensions). A candidate's local score in a list is the
inner product over that slice; its score is their sum. Queries and candidates meet in blocks: every block of queries
with every block of candidates, once, found by an equal block number.

Phase 1  every block gathers, for each query, the best entries of every list and completes their scores; its k best go
         out, and with them the block's bound: the sum of the lists' last gathered scores, which no candidate that is
         not in a list can exceed. The k-th best score over all blocks is a safe cutoff.
Phase 2  blocks whose bound is below a query's cutoff are done with that query. To the others the cutoff goes back out:
         a candidate that reaches it has a local score of at least cutoff / LISTS in one list. Those entries are
         collected, and the ones whose known parts and that threshold for each missing one fall short are dropped.
Phase 3  the survivors' missing local scores are resolved exactly; who reaches the cutoff goes to the final ranking.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed

LISTS = 2
#: Bytes of components in a block of queries and in a block of candidates: with the scores of a strip they bound a
#: task's memory at any table size. A vector is shuffled once for each block of queries, an entry once for each block
#: of candidates, so blocks are as large as memory allows.
QUERY_BYTES = 16 << 20
CANDIDATE_BYTES = 64 << 20
#: Rows of a block of candidates, at least, where a table is cut finer than memory asks.
LEAST_ROWS = 4096
#: Entries of a list that a block gathers: this many times k, or the block's rows over this, whichever is more.
DEPTH = 8
DEPTH_SHARE = 32
#: Local scores that are held at once, of all lists together.
STRIP_SCORES = 1 << 24
_LONG = (1 << 63) - 1


def quantized(vectors: DataFrame, scale: int = 64, key: str = "vec_id", value: str = "embedding") -> DataFrame:
    """vec_id, v: floor(scale * x) of every component x as a double, kept as doubles.

    Rows with a null id, a null vector, or a null or non-finite component take no part. An empty vector does.
    """
    doubles = F.transform(F.col(value), lambda e: e.cast("double"))
    fit = F.forall("x", lambda e: e.isNotNull() & (F.abs(e) < F.lit(float("inf"))))  # false for NaN, which is above all
    return (
        vectors.select(F.col(key).cast("long").alias("vec_id"), doubles.alias("x"))
        .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & fit)
        .select("vec_id", F.transform("x", lambda e: _floor(e * F.lit(float(scale)))).alias("v"))
    )


def _floor(y: F.Column) -> F.Column:
    # floor() gives a long; doubles from 2**53 on are whole numbers as they are.
    return F.when(F.abs(y) < F.lit(float(1 << 53)), F.floor(y).cast("double")).otherwise(y)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]
    return np.concatenate(flat).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _exact(q: np.ndarray, c: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, k: int):
    """For components so large that doubles would round: whole Python integers, held to the range of a long."""
    rows = [[int(x) for x in r] for r in c]
    for query_id, vector in zip(query_ids, q, strict=True):
        whole = [int(x) for x in vector]
        scored = [(-sum(a * b for a, b in zip(whole, r, strict=True)), i) for r, i in zip(rows, ids.tolist(), strict=True) if i != query_id]
        for score, vec_id in sorted(scored)[:k]:
            yield query_id, vec_id, min(max(-score, -_LONG - 1), _LONG)


def _local(q: np.ndarray, c: np.ndarray, own_ids: np.ndarray, ids: np.ndarray, kind) -> list[np.ndarray]:
    """Local scores of every query and candidate in every list; a query's own row is out of reach."""
    dims = q.shape[1]
    edges = [dims * i // LISTS for i in range(LISTS + 1)]
    local = [q[:, a:b].astype(kind) @ c[:, a:b].astype(kind).T for a, b in zip(edges, edges[1:], strict=False)]
    order = np.argsort(ids, kind="stable")
    low, high = np.searchsorted(ids[order], own_ids, side="left"), np.searchsorted(ids[order], own_ids, side="right")
    for i in np.flatnonzero(low < high):
        for m in local:
            m[i, order[low[i] : high[i]]] = -np.inf
    return local


def gather(local: list[np.ndarray], depth: int):
    """Phase 1: (places, scores, bound) of each query's gathered entries, completed; entries that two lists hold count once.

    bound: no other candidate's score is higher (minus infinity if there is no other).
    """
    n_queries, n = local[0].shape
    if n <= depth:
        return np.broadcast_to(np.arange(n), (n_queries, n)), sum(m.astype(np.float64) for m in local), np.full(n_queries, -np.inf)
    tops = [np.argpartition(m, n - depth, axis=1)[:, n - depth :] for m in local]
    bound = sum(np.take_along_axis(m, t[:, :1], 1)[:, 0].astype(np.float64) for m, t in zip(local, tops, strict=True))
    seen = np.sort(np.concatenate(tops, axis=1), axis=1)
    total = sum(np.take_along_axis(m, seen, 1).astype(np.float64) for m in local)
    total[:, 1:][seen[:, 1:] == seen[:, :-1]] = -np.inf
    return seen, total, bound


def resolve(local: list[np.ndarray], cutoff: np.ndarray):
    """Phases 2 and 3: (query, place, score) of every candidate that reaches its query's cutoff; how many were resolved.

    Collected are the entries of a local score of at least cutoff / LISTS. A missing local score is below that, so
    known parts plus that much for each missing one bound the score; only where this reaches the cutoff are the
    missing scores looked up.
    """
    share = (cutoff / LISTS)[:, None]
    known, missing = np.zeros(local[0].shape), np.zeros(local[0].shape, np.int8)
    for m in local:
        held = m >= share
        known[held] += m[held]
        missing += ~held
    r, at = np.nonzero((missing < LISTS) & (known + missing * share >= cutoff[:, None]))
    total = sum(m[r, at].astype(np.float64) for m in local)
    resolved = int((missing[r, at] > 0).sum())
    enough = (total >= cutoff[r]) & np.isfinite(total)
    return r[enough], at[enough], total[enough], resolved


def _block_scorer(phase: int, k: int, depth: int, share: int):
    """The work of phase 1, or of phases 2 and 3, on one block of queries and one block of candidates."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _OUT.empty_table()
        cb = left.column("cb")[0].as_py()
        query_ids, ids = left.column("query_id").to_numpy(), right.column("vec_id").to_numpy()
        q, c = _matrix(left.column("v")), _matrix(right.column("v"))
        bound = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
        if bound >= 1 << 53:
            # Each block's exact k best: with no bound sent, its queries are done.
            rows = list(_exact(q, c, query_ids, ids, k)) if phase == 1 else []
            return _entries(cb, *zip(*rows)) if rows else _OUT.empty_table()
        # Whole numbers below 2**24 add exactly as floats, below 2**53 as doubles.
        kind = np.float32 if bound < 1 << 24 else np.float64
        strip = max(1, STRIP_SCORES // (LISTS * len(ids)))
        out = []
        for at in range(0, len(query_ids), strip):
            own_ids = query_ids[at : at + strip]
            local = _local(q[at : at + strip], c, own_ids, ids, kind)
            if phase == 2:
                r, places, total, _ = resolve(local, left.column("cutoff").to_numpy()[at : at + strip].astype(np.float64))
                order = np.lexsort((ids[places], -total, r))
                r, places, total = r[order], places[order], total[order]
                kept = np.arange(len(r)) - np.searchsorted(r, r, side="left") < k
                out.append(_entries(cb, own_ids[r[kept]], ids[places[kept]], total[kept]))
                continue
            places, total, limit = gather(local, max(1, depth * k, len(ids) // share))
            order = np.lexsort((ids[places], -total), axis=-1)[:, :k]
            best, total = ids[np.take_along_axis(places, order, 1)], np.take_along_axis(total, order, 1)
            there = np.isfinite(total)
            out.append(_entries(cb, np.repeat(own_ids, there.sum(1)), best[there], total[there]))
            more = np.isfinite(limit)
            out.append(_entries(cb, own_ids[more], None, None, limit[more]))
        return pa.concat_tables(out)

    return run


def _entries(cb: int, query_ids, ids=None, scores=None, bounds=None) -> pa.Table:
    n = len(query_ids)
    column = lambda values, kind: pa.nulls(n, kind) if values is None else pa.array(np.asarray(values).astype(kind.to_pandas_dtype()), kind)
    return pa.Table.from_arrays([column(query_ids, pa.int64()), column(ids, pa.int64()), column(scores, pa.int64()), pa.array(np.full(n, cb, np.int32)), column(bounds, pa.float64())], schema=_OUT)


_OUT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("cb", pa.int32()), ("bound", pa.float64())])
_DDL = "query_id long, vec_id long, score long, cb int, bound double"


def search(
    vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, key: str = "vec_id", value: str = "embedding",
    query_bytes: int = QUERY_BYTES, candidate_bytes: int = CANDIDATE_BYTES, depth: int = DEPTH, share: int = DEPTH_SHARE,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest scores (all, if fewer), ties to smaller vec_id.

    Queries are the rows whose id is divisible by ``every``; candidates every row whose id isn't the query's.
    Only vectors of as many components meet. Rows that repeat a query's id are one query (its smallest
    vector); rows that repeat a candidate are candidates of their own, dealt to blocks row by row. Scores beyond a
    long are held to its range. Other columns are dropped. Empty tables give no rows.
    """
    marked = quantized(vectors, scale, key, value).withColumn("row", F.xxhash64(F.monotonically_increasing_id()))
    points = checkpointed(marked)  # row numbers hold from here on
    queries = points.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    whole = points.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    width = 8 * max(1, whole[1] or 1)
    query_blocks = max(1, -(-whole[0] * width // (every * query_bytes)))
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    spread = min(-(-cores // query_blocks), -(-whole[0] // LEAST_ROWS))  # a table of few blocks is cut finer, a task for each core
    candidate_blocks = max(1, spread, -(-whole[0] * width // candidate_bytes))
    numbers = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    part = lambda hashed, count: F.pmod(hashed, F.lit(count)).cast("int")
    keys = ["dims", "qb", "cb"]
    left = queries.select("*", F.size("v").alias("dims"), part(F.xxhash64("query_id"), query_blocks).alias("qb"))
    right = points.select("vec_id", "v", F.size("v").alias("dims"), part(F.col("row"), candidate_blocks).alias("cb"), numbers(query_blocks).alias("qb"))
    met = lambda a, b, phase: a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInArrow(_block_scorer(phase, k, depth, share), _DDL)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    first = checkpointed(met(left.select("*", numbers(candidate_blocks).alias("cb")), right, 1))
    entries = first.where("bound IS NULL").drop("bound")
    # A query of fewer than k entries has no cutoff: every score qualifies in the blocks that hold more than they sent.
    cutoffs = ranked(entries).where(F.col("rank") == k).select("query_id", F.col("score").alias("cutoff"))
    cutoff = F.coalesce("cutoff", F.lit(-_LONG - 1))
    open_ = first.where("bound IS NOT NULL").join(cutoffs, "query_id", "left").withColumn("cutoff", cutoff).where("bound >= cutoff")
    open_ = checkpointed(open_.select("query_id", "cb", "cutoff"))
    if not open_.isEmpty():
        again = left.join(open_, "query_id")
        resolved = met(again, right.join(again.select(*keys).distinct(), keys, "left_semi"), 2)
        entries = entries.join(open_, ["query_id", "cb"], "left_anti").unionByName(resolved.drop("bound"))
    return ranked(entries).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
