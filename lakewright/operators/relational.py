"""Relational operators that the analyses share: ordered distinct, filling forward, as-of and range joins, top-k, set comparison.

Windows over a key hold that key's rows in one task. Where a key may hold a large share of a table, the
functions here take a ``bucket`` of the order column and work in two levels: inside (key, bucket), then over one
summary row for each (key, bucket).
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a side that may be broadcast; beyond it joins shuffle.
MAX_BROADCAST_ROWS = 200_000


def small(df: DataFrame, rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it is counted to hold no more than ``rows``; as it is otherwise."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def ordered_distinct(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Distinct keys with the smallest order value of each: partial aggregates, then one shuffle."""
    return df.groupBy(*keys).agg(F.min(order).alias(order))


def ordered_list(value: str, order: str) -> Column:
    """Aggregate: values in order, each once, at its first place."""
    return F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]))


def sorted_set(value) -> Column:
    return F.array_sort(F.collect_set(value))


def keep_last(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row of each key: the last in order, at the place (column ``order``) of the first."""
    names = [c for c in df.columns if c not in (key, order)]
    held = df.groupBy(key).agg(F.max_by(F.struct(*names), order).alias("v"), F.min(order).alias(order))
    return held.select(*[key if c == key else order if c == order else F.col(f"v.{c}").alias(c) for c in df.columns])


def fill_forward(df: DataFrame, keys: list[str], order: list[str], value: Column, into: str, bucket: Column | None = None, strictly: bool = False) -> DataFrame:
    """df with ``into``: the last non-null value of the key up to the row (strictly: before it).

    With ``bucket``, which must not fall as the order rises, a key's rows are spread over its buckets; what a
    bucket starts from is the last value of the buckets before it, found over one row for each bucket.
    """
    df = df.withColumn("__v", value)
    edge = -1 if strictly else 0
    if bucket is None:
        over = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, edge)
        return df.withColumn(into, F.last("__v", ignorenulls=True).over(over)).drop("__v")
    df = df.withColumn("__b", bucket)
    last = F.max_by("__v", F.when(F.col("__v").isNotNull(), F.struct(*order))).alias("__last")
    sums = df.groupBy(*keys, "__b").agg(last)
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__carried", F.last("__last", ignorenulls=True).over(before)).drop("__last")
    within = Window.partitionBy(*keys, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, edge)
    own = df.withColumn("__own", F.last("__v", ignorenulls=True).over(within))
    on = [own[k].eqNullSafe(sums[k]) for k in (*keys, "__b")]
    joined = own.join(sums.select(*keys, "__b", "__carried"), on, "left")
    return joined.select(*[own[c] for c in df.columns if c not in ("__v", "__b")], F.coalesce("__own", "__carried").alias(into))


def nearest(left: DataFrame, right: DataFrame, key: list[str], at: str, n: int, side: str, tie: str) -> DataFrame:
    """Pairs of a left row and its n nearest right rows of the key: the last at or before it, or the first at or after.

    left and right have columns key, at and tie (an id). Every right row is numbered within its key once; a left
    row carries the number reached so far, so its partners are n consecutive numbers: an equi-join on key and
    number, without looking at all pairs. Rows without a place have no neighbours.
    """
    if side not in ("before", "after"):
        raise ValueError(side)
    along = F.asc if side == "before" else F.desc
    placed = lambda df: df.where(F.col(at).isNotNull())
    other = placed(right).select(*key, F.col(at).alias("r_at"), F.col(tie).alias("r_id"), F.col(at).alias("__x"), F.lit(0).alias("__left"), F.col(tie).alias("__t"))
    own = placed(left).select(*key, F.col(at).alias("l_at"), F.col(tie).alias("l_id"), F.col(at).alias("__x"), F.lit(1).alias("__left"), F.col(tie).alias("__t"))
    both = own.unionByName(other, allowMissingColumns=True)
    # Right rows of the same place come before the left row, which may take them.
    over = Window.partitionBy(*key).orderBy(along("__x"), "__left", along("__t")).rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("__n", F.sum(1 - F.col("__left")).over(over))
    numbered = both.where("__left = 0").select(*key, "__n", "r_at", "r_id")
    wanted = both.where("__left = 1 AND __n > 0").select(*key, "l_at", "l_id", F.col("__n").alias("__top"), F.explode(F.sequence(F.greatest(F.lit(1), F.col("__n") - n + 1), F.col("__n"))).alias("__n"))
    return wanted.join(numbered, [*key, "__n"]).withColumn("place", (F.col("__top") - F.col("__n") + 1).cast("int")).drop("__n", "__top")


def successive_in_ranges(pairs: DataFrame, order: DataFrame, ranges: DataFrame, key: str = "file") -> DataFrame:
    """Pairs (src, dst) that stand next to each other in order(key, paragraph, ord) inside a range, with that range.

    ranges(key, range_start, range_end) are resolved to positions first; backward ranges hold nothing. Joined on
    the key, with the interval as a residual.
    """
    place = order.select(key, "paragraph", "ord")
    at = lambda name, col: place.select(key, F.col("paragraph").alias(name), F.col("ord").alias(col))
    spans = ranges.join(at("range_start", "lo"), [key, "range_start"]).join(at("range_end", "hi"), [key, "range_end"]).where("lo <= hi")
    placed = pairs.join(at("src", "a"), [key, "src"]).join(at("dst", "b"), [key, "dst"]).where("b = a + 1")
    return placed.join(spans, key).where("a >= lo AND b <= hi").select(*pairs.columns, "range_start", "range_end")


def slice_between(order: DataFrame, start: str, end: str, key: str = "file") -> DataFrame:
    """The part of order(key, paragraph, ord) between two names, ends included; nothing if it runs backwards or lacks one."""
    lo = F.min(F.when(F.col("paragraph") == start, F.col("ord"))).over(Window.partitionBy(key))
    hi = F.min(F.when(F.col("paragraph") == end, F.col("ord"))).over(Window.partitionBy(key))
    return order.withColumn("__lo", lo).withColumn("__hi", hi).where("ord BETWEEN __lo AND __hi").drop("__lo", "__hi")


def preceding_block(marks: DataFrame, notes: DataFrame, key: str, at: str, max_distance: int = 6, max_gap: int = 2) -> DataFrame:
    """key, mark, note: for each mark the notes shortly before it, up to the first gap above max_gap, nearest first broken off.

    A note within max_distance joins by the cell of its position (at most two cells for a mark), an equi-join.
    """
    cell = lambda c: F.floor(c / (max_distance + 1))
    m = marks.select(key, F.col(at).alias("mark")).distinct().withColumn("__c", F.explode(F.array(cell(F.col("mark")), cell(F.col("mark")) - 1)))
    s = notes.select(key, F.col(at).alias("note")).withColumn("__c", cell(F.col("note")))
    near = m.join(s, [key, "__c"]).where((F.col("note") < F.col("mark")) & (F.col("mark") - F.col("note") <= max_distance)).drop("__c")
    back = Window.partitionBy(key, "mark").orderBy(F.desc("note"))
    gap = F.lag("note", 1).over(back)
    broken = F.when(F.coalesce(gap, F.col("mark")) - F.col("note") > max_gap, 1).otherwise(0)
    near = near.withColumn("__broken", broken).withColumn("__sum", F.sum("__broken").over(back.rowsBetween(Window.unboundedPreceding, 0)))
    return near.where("__sum = 0").select(key, "mark", "note")


def top_k(df: DataFrame, order: list, k: int) -> DataFrame:
    """The first k rows: each task keeps its own k (TakeOrderedAndProject); ties need an order that tells rows apart."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, keys: list[str], order: list, k: int, into: str = "rank") -> DataFrame:
    """The first k rows of each group. Spark cuts groups to k rows before the shuffle (WindowGroupLimit)."""
    over = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(into, F.row_number().over(over)).where(F.col(into) <= k)


def set_compare(left: DataFrame, right: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """by, n_left, n_right, n_common, missing and extra counts of the distinct keys of both sides, for each ``by``.

    One union and two aggregates; no join.
    """
    both = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r")))
    each = both.groupBy(*keys).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    n = lambda c: F.count_if(c)
    l, r = F.col("l") == 1, F.col("r") == 1
    return each.groupBy(*by).agg(n(l).alias("n_left"), n(r).alias("n_right"), n(l & r).alias("n_common"), n(l & ~r).alias("n_missing"), n(r & ~l).alias("n_extra"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """0/0 is 1: nothing was to be found, and nothing is missing."""
    return F.when(denominator == 0, 1.0).otherwise(numerator / F.nullif(denominator, F.lit(0)))


def f1(recall: Column, precision: Column) -> Column:
    return F.when(recall + precision == 0, 0.0).otherwise(2 * recall * precision / F.nullif(recall + precision, F.lit(0.0)))


def set_relation(n_missing: Column, n_extra: Column) -> Column:
    """EXACT, RIGHT_SUPERSET, LEFT_SUPERSET or DIFFERENT by how much either side lacks."""
    return F.when((n_missing == 0) & (n_extra == 0), "EXACT").when(n_missing == 0, "RIGHT_SUPERSET").when(n_extra == 0, "LEFT_SUPERSET").otherwise("DIFFERENT")


def coverage(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """key, status (MISSING or EXTRA): what only one side has."""
    a, b = expected.select(key).distinct(), found.select(key).distinct()
    missing = a.join(b, key, "left_anti").withColumn("status", F.lit("MISSING"))
    return missing.unionByName(b.join(a, key, "left_anti").withColumn("status", F.lit("EXTRA")))


def match_status(left: DataFrame, right: DataFrame, key: str, same: Column | None = None) -> DataFrame:
    """Full outer join of two keyed tables with status LEFT_ONLY, RIGHT_ONLY, MATCH (or, by ``same`` over l and r, DIFFERENT)."""
    joined = left.alias("l").join(right.alias("r"), key, "full_outer")
    status = F.when(F.col("r.__in").isNull(), "LEFT_ONLY").when(F.col("l.__in").isNull(), "RIGHT_ONLY")
    status = status.otherwise("MATCH") if same is None else status.when(same, "MATCH").otherwise("DIFFERENT")
    return joined.withColumn("status", status)


def present(df: DataFrame) -> DataFrame:
    """df with the mark that match_status() looks for."""
    return df.withColumn("__in", F.lit(True))


def grouping_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Counts by each column and by all together, in one pass over the rows.

    The rows are counted by all columns first; only those counts are expanded to the grouping sets.
    """
    whole = df.groupBy(*columns).count()
    sets = [[F.col(c)] for c in columns] + [[F.col(c) for c in columns]]
    grouped = whole.groupingSets(sets, *columns).agg(F.sum("count").alias("n"), F.grouping_id().alias("level"))
    return grouped.select(*columns, "n", "level")


def first_by_priority(wanted: DataFrame, candidates: DataFrame, key: str, value: str) -> DataFrame:
    """wanted with ``value`` of the first of its keys (an array, best first) that candidates have; null if none."""
    each = wanted.select("*", F.posexplode_outer(key).alias("__rank", "__key"))
    best = candidates.groupBy(F.col(key).alias("__key")).agg(F.min(value).alias("__value"))
    found = each.join(best, "__key", "left")
    names = [F.first(c).alias(c) for c in wanted.columns if c != "id"]
    return found.groupBy("id").agg(*names, F.min_by("__value", F.when(F.col("__value").isNotNull(), F.col("__rank"))).alias(value))


#: Characters of the seed by which a passage of few words is looked for.
SEED_CHARACTERS = 4


def contains_join(texts: DataFrame, passages: DataFrame, text: str, passage: str, words: int = 3) -> DataFrame:
    """Pairs of a text and a passage that it contains as a substring.

    No comparison of every pair: a passage is looked for by a seed that a text which contains it must have too. That is
    one run of ``words`` whole words inside the passage, not touching its ends, where the text may go on within a word;
    or, of a passage too short for one, its first SEED_CHARACTERS characters (all, if it has fewer; an empty passage is
    in every text). Texts are cut to characters only for the seed lengths that some passage needs.
    """
    split = lambda c: F.split(c, " ")
    inner = F.slice(split(F.col(passage)), 2, F.greatest(F.lit(0), F.size(split(F.col(passage))) - 2))
    shifted = lambda parts, n, glue: functools.reduce(lambda runs, k: F.zip_with(runs, F.slice(parts, k + 1, 1 << 30), lambda a, b: F.concat(a, F.lit(glue), b)), range(1, n), parts)
    hashed = lambda kind, runs: F.transform(F.filter(runs, lambda r: r.isNotNull()), lambda r: F.xxhash64(F.lit(kind), r))
    kind = F.when(F.size(inner) >= words, -1).otherwise(F.least(F.lit(SEED_CHARACTERS), F.length(passage)))
    seed = F.when(F.col("__kind") < 0, F.array_join(F.slice(inner, 1, words), " ")).otherwise(F.substring(F.col(passage), 1, SEED_CHARACTERS))
    named = passages.where(F.col(passage).isNotNull()).withColumn("__kind", kind).withColumn("__seed", F.xxhash64("__kind", seed)).drop("__kind")
    kinds = [r[0] for r in passages.where(F.col(passage).isNotNull()).select(kind).distinct().collect()]  # at most SEED_CHARACTERS + 2
    found = []
    for k in sorted(kinds):
        # Zipped with its own shifts: the text is split once for each length, not once a word or character.
        runs = shifted(split(F.col(text)), words, " ") if k < 0 else F.array(F.lit("")) if k == 0 else shifted(F.split(F.col(text), ""), k, "")
        found.append(hashed(k, runs))
    seeds = F.array_distinct(F.concat(*found)) if found else F.array().cast("array<bigint>")
    # Only seeds that some passage has are kept before anything meets: the passages' side is the small one.
    exploded = texts.withColumn("__seed", F.explode(seeds))
    wanted = small(named.select("__seed").distinct())
    return exploded.join(wanted, "__seed", "left_semi").join(small(named), "__seed").where(F.contains(F.col(text), F.col(passage))).drop("__seed")


def prefix_join(names: DataFrame, prefixes: DataFrame, name: str, prefix: str, separator: str = "-") -> DataFrame:
    """Pairs where a name is a prefix or goes on from it after the separator.

    Every cut of a name at a separator is a possible prefix: exploded, then equi-joined.
    """
    parts = F.split(F.col(name), f"\\Q{separator}\\E")
    cuts = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), separator))
    return names.withColumn("__cut", F.explode(cuts)).join(prefixes, F.col("__cut") == F.col(prefix)).drop("__cut")
