"""Balanced label propagation: documents move towards their neighbours' shards under capacity quotas.

DataFrame operations only. Linked documents are those of equal text. Every document starts in a shard by the
hash of its id. Documents of one text that start alike form a fragment (at most CELLS for a text, so a text
that holds a third of all rows is still a few dozen rows, and a fragment is small against a shard). Each round
joins the fragments with their text's votes (how many copies each shard holds), and moves fragments to the
shard with most, as far as the quotas leave room. Documents without copies have no preference and give way:
at the end those over a shard's quota, copies last of all, fill the places that are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed

ROUNDS = 10
#: Starting cells; a cell's remainder by the shard count is its first shard.
CELLS = 64
#: Pieces of a shard that are numbered separately, so that no task numbers a whole shard; more for large inputs.
PIECES = 32
#: Rows of a piece, about: what one task numbers.
PIECE_ROWS = 250_000
TEXT = ["g", "text_crc32", "size"]


def fingerprinted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 1), text_crc32, g and cell: all that is needed of a document."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(
        F.col(key).cast("long").alias("doc_id"),
        (F.octet_length(t).cast("long") + 1).alias("size"),
        F.crc32(t.cast("binary")).alias("text_crc32"),
        F.xxhash64(t).alias("g"),
        F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(CELLS)).cast("int").alias("cell"),
    )


def quotas(rows: int, shards: int) -> list[int]:
    """Places of each shard: counts at most one apart."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def propagate(fragments: DataFrame, places: list[int], rounds: int = ROUNDS, pieces: int = PIECES) -> DataFrame:
    """fragments(TEXT, cell, n, shard) with the shards that label propagation ends in.

    Only counts leave the executors: one load for each shard and round.
    """
    shards = len(places)
    fragments = checkpointed(fragments)
    for _ in range(rounds):
        load = dict(fragments.groupBy("shard").agg(F.sum("n")).collect())
        room = [places[s] - (load.get(s) or 0) for s in range(shards)]
        held = F.array(*[F.lit(max(0, r)).cast("long") for r in room])
        votes = fragments.groupBy(*TEXT, "shard").agg(F.sum("n").alias("v"))
        # Of equal votes the shard with more room wins, so no text waits for a full shard while another could hold it.
        order = sorted(range(shards), key=lambda s: (room[s], -s))
        rank = lambda s: F.element_at(F.array(*[F.lit(order.index(i)) for i in range(shards)]), (s + 1).cast("int"))
        votes = votes.groupBy(*TEXT).agg(F.collect_list(F.struct("v", rank(F.col("shard")).alias("r"), F.col("shard").alias("s"))).alias("votes"))
        seen = fragments.join(votes, TEXT)
        own = F.aggregate("votes", F.lit(0).cast("long"), lambda a, x: F.when(x["s"] == F.col("shard"), x["v"]).otherwise(a))
        better = lambda x: (x["v"] > own) | ((x["v"] == own) & (x["r"] > rank(F.col("shard"))))
        fits = lambda x: F.element_at(held, (x["s"] + 1).cast("int")) >= F.col("n")
        target = F.array_max(F.filter("votes", lambda x: better(x) & fits(x)))
        wish = seen.withColumn("wish", target).select(
            *TEXT, "cell", "n", "shard", F.col("wish.s").cast("int").alias("to"), (F.col("wish.v") - own).alias("gain")
        )
        # Movers in order of gain; classes of similar gain are numbered apart, then offset by the classes before.
        turn = F.when(F.col("to").isNotNull(), F.floor(F.log2(F.col("gain") + 1)) * -pieces + F.pmod(F.col("g"), F.lit(pieces)))
        wish = checkpointed(wish.withColumn("class", turn))
        classes = wish.where("to IS NOT NULL").groupBy("to", "class").agg(F.sum("n").alias("sum"))
        # At most shards * 64 gain classes * pieces rows.
        before = Window.partitionBy("to").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
        classes = classes.withColumn("before", F.coalesce(F.sum("sum").over(before), F.lit(0))).drop("sum")
        within = Window.partitionBy("to", "class").orderBy(*TEXT, "cell").rowsBetween(Window.unboundedPreceding, 0)
        movers = wish.where("to IS NOT NULL").withColumn("upto", F.sum("n").over(within)).join(F.broadcast(classes), ["to", "class"])
        movers = movers.where(F.col("before") + F.col("upto") <= F.element_at(held, F.col("to") + 1))
        accepted = movers.select(*TEXT, "cell", "to")
        moved = wish.drop("to").join(accepted, [*TEXT, "cell"], "left")
        moved = moved.select(*TEXT, "cell", "n", F.coalesce("to", "shard").alias("shard"), F.col("to").isNotNull().alias("moved"))
        fragments = checkpointed(moved)
        if fragments.where("moved").limit(1).count() == 0:
            break
        fragments = fragments.drop("moved")
    return fragments.select(*TEXT, "cell", "n", "shard")


def assign(docs: DataFrame, shards: int = 8, rounds: int = ROUNDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law ("rows"), shard, slot, grown_shard (null) of every document.

    Shards differ by one row at most; slots count from 0 without gaps. Copies share a shard where it can hold
    them. Null texts count as empty ones: size 1, linked to them. Repeated rows each get a place. A null doc_id
    is placed like any other. No documents: no rows. The result depends on the rows alone, not on their order.
    """
    rows = checkpointed(fingerprinted(docs, key, text))
    total = rows.count()
    places, pieces = quotas(total, shards), max(PIECES, -(-total // (shards * PIECE_ROWS)))
    fragments = rows.groupBy(*TEXT, "cell").agg(F.count(F.lit(1)).alias("n"))
    copies = fragments.groupBy(*TEXT).agg(F.sum("n").alias("copies")).where("copies > 1").select(*TEXT)
    linked = fragments.join(copies, TEXT).withColumn("shard", F.pmod(F.col("cell"), F.lit(shards)))
    found = propagate(linked, places, rounds, pieces).select(*TEXT, "cell", F.col("shard").alias("found"))
    placed = rows.join(found, [*TEXT, "cell"], "left").select(
        "doc_id",
        "size",
        "text_crc32",
        F.coalesce("found", F.pmod(F.col("cell"), F.lit(shards))).alias("shard"),
        F.col("found").isNull().alias("alone"),
        F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(pieces)).cast("int").alias("piece"),
    )
    placed = checkpointed(placed)
    parts = ["shard", "alone", "piece"]
    counts = placed.groupBy(*parts).agg(F.count(F.lit(1)).alias("count"))  # at most shards * 2 * pieces rows
    before = Window.partitionBy("shard").orderBy("alone", "piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(counts.select(*parts, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")))
    load = dict(counts.groupBy("shard").agg(F.sum("count")).collect())
    totals = [load.get(s, 0) for s in range(shards)]
    numbered = placed.join(offsets, parts).withColumn(
        "rank", F.col("start") + F.row_number().over(Window.partitionBy(*parts).orderBy("doc_id", "size", "text_crc32")) - 1
    )
    # Rows beyond a shard's places, numbered through all shards, fill the free places in order.
    spill, free, seen, given = [], [], 0, 0
    for s in range(shards):
        spill.append(seen - places[s])
        seen += max(0, totals[s] - places[s])
        if totals[s] < places[s]:
            free.append((given, s))
            given += places[s] - totals[s]
    over = F.element_at(F.array(*[F.lit(x).cast("long") for x in spill]), F.col("shard") + 1) + F.col("rank")
    kept = F.col("rank") < F.element_at(F.array(*[F.lit(x).cast("long") for x in places]), F.col("shard") + 1)
    shard, slot = F.col("shard"), F.col("rank")
    chosen_shard = chosen_slot = None
    for first, s in free:
        here, place = F.lit(s), over - first + totals[s]
        chosen_shard = here if chosen_shard is None else F.when(over >= first, here).otherwise(chosen_shard)
        chosen_slot = place if chosen_slot is None else F.when(over >= first, place).otherwise(chosen_slot)
    if free:
        shard, slot = F.when(kept, shard).otherwise(chosen_shard), F.when(kept, slot).otherwise(chosen_slot)
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        shard.cast("int").alias("shard"),
        slot.cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
