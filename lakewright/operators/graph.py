"""Control-flow graphs: extraction from statements, typing, conditions, ranges, reachability and comparison."""

from __future__ import annotations

import functools
from collections import defaultdict, deque
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.conditions import branch_conditions_udf
from ..functions.text import paragraph_name, strip
from ..sources import cobol
from .relational import f1, ratio, set_relation, successive_in_ranges

_RANGE = r"\bPERFORM\b\s+([A-Z0-9-]+)\s+(?:THRU|THROUGH)\s+([A-Z0-9-]+)"
_PERFORM = r"\bPERFORM\b\s+([A-Z0-9-]+)\b"


def performed(statement: Column) -> tuple[Column, Column]:
    """(target, range end or null) of a PERFORM; inline loops have no target."""
    u = F.upper(statement)
    start, end = F.nullif(F.regexp_extract(u, _RANGE, 1), F.lit("")), F.nullif(F.regexp_extract(u, _RANGE, 2), F.lit(""))
    name = F.nullif(F.regexp_extract(u, _PERFORM, 1), F.lit(""))
    return F.coalesce(start, F.when(~name.isin("UNTIL", "VARYING", "TEST"), name)), end


def gone_to(statement: Column) -> Column:
    """Targets of a GO TO, also of several DEPENDING ON a value."""
    u = F.upper(statement)
    rest = F.coalesce(F.nullif(F.regexp_extract(u, r"\bGO\s+TO\b\s+(.+)", 1), F.lit("")), F.regexp_extract(u, r"\bGOTO\b\s+(.+)", 1))
    found = F.regexp_extract_all(F.replace(F.substring_index(rest, "DEPENDING", 1), F.lit("."), F.lit(" ")), F.lit(r"\b([A-Z][A-Z0-9-]*)\b"), 1)
    targets = F.filter(found, lambda t: ~t.isin(*sorted(fixed.FLOW_WORDS)))
    return F.when(F.contains(u, F.lit("NEXT SENTENCE")), F.array().cast("array<string>")).otherwise(targets)


def ends_paragraph(statement: Column) -> Column:
    """Nothing falls through after it."""
    u = F.upper(strip(statement))
    return u.rlike("^(GO TO |GOTO |STOP RUN|GOBACK|EXIT PROGRAM|RETURN)") | (u.rlike("^EXEC CICS") & u.rlike(" RETURN| XCTL"))


def extract(lines: DataFrame, strict_names: bool = True, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """(nodes(program, node), edges(program, edge_no, src, dst)) of program text.

    Edges come in the order of discovery: performs and jumps paragraph by paragraph, then what ranges run through,
    then falls into the next paragraph. The first of equal pairs counts. ``keep`` is applied to what is used more than
    once: without it every use is planned anew, and one task may hold the buffers of all of them.
    """
    pattern = r"(?i)PROGRAM-ID\.\s*([A-Z0-9-]+)\." if strict_names else r"(?i)PROGRAM-ID\.\s*([A-Z0-9-]+)"
    programs = cobol_programs(lines, pattern)
    stmts = cobol.procedure_statements(cobol.statements(lines, "*/D", inline_comments=False), toggles=False)
    order = keep(cobol.paragraph_order(stmts, programs))
    body = cobol.with_paragraphs(stmts.join(programs, "file"), F.col("program"), fixed.FLOW_WORDS, drop_words=False)
    body = keep(body.join(order, ["file", "paragraph"]))
    target, end = performed(F.col("statement"))
    u = F.upper("statement")
    loop = F.contains(u, F.lit("PERFORM")) & u.rlike(" UNTIL | VARYING ") & target.isNull()
    own = F.concat(F.array(F.coalesce(target, F.when(loop, F.col("paragraph")))), gone_to(F.col("statement")))
    direct = body.select("file", F.col("paragraph").alias("src"), F.struct(F.lit(0).alias("stage"), "ord", F.col("line_start").alias("line")).alias("k"), F.posexplode(own).alias("pos", "dst"))
    direct = direct.where("dst IS NOT NULL").select("file", "src", "dst", F.struct("k.stage", "k.ord", "k.line", "pos").alias("k"))
    nexts = order.select("file", F.col("paragraph").alias("src"), "ord", F.lead("paragraph").over(Window.partitionBy("file").orderBy("ord")).alias("dst")).where("dst IS NOT NULL")
    ranges = body.where(end.isNotNull()).select("file", target.alias("range_start"), end.alias("range_end"), "ord", "line_start")
    through = successive_in_ranges(nexts.select("file", "src", "dst"), order, ranges.drop("ord", "line_start").distinct())
    first_use = ranges.groupBy("file", "range_start", "range_end").agg(F.min(F.struct("ord", "line_start")).alias("u"))
    through = through.join(first_use, ["file", "range_start", "range_end"]).join(order.select("file", F.col("paragraph").alias("src"), F.col("ord").alias("pos")), ["file", "src"])
    through = through.select("file", "src", "dst", F.struct(F.lit(1).alias("stage"), F.col("u.ord").alias("ord"), F.col("u.line_start").alias("line"), F.col("pos")).alias("k"))
    last = body.groupBy("file", F.col("paragraph").alias("src")).agg(F.max_by("statement", "line_start").alias("last"))
    falls = nexts.join(last, ["file", "src"], "left").where(F.col("last").isNull() | ~ends_paragraph(F.col("last")))
    falls = falls.select("file", "src", "dst", F.struct(F.lit(2).alias("stage"), "ord", F.lit(0).alias("line"), F.lit(0).alias("pos")).alias("k"))
    pairs = direct.unionByName(through).unionByName(falls).groupBy("file", "src", "dst").agg(F.min("k").alias("k")).join(programs, "file")
    number = F.row_number().over(Window.partitionBy("program").orderBy("k"))
    edges = keep(pairs.select("program", number.alias("edge_no"), "src", "dst"))
    # A perform or jump brings its target into the graph even where no paragraph has that name.
    nodes = order.join(programs, "file").select("program", F.col("paragraph").alias("node")).union(edges.select("program", "dst")).distinct()
    return nodes, edges


def cobol_programs(lines: DataFrame, pattern: str) -> DataFrame:
    from ..sources.text import program_names

    return program_names(lines, pattern)


def typed(edges: DataFrame, paragraph_lines: DataFrame) -> DataFrame:
    """edges(program, edge_no, src, dst) with type, evidence, range_start, range_end.

    The first line of the source paragraph that reaches the target decides; within a line a range comes before a
    perform, a perform before a jump. No such line: FALLTHROUGH.
    """
    u = F.upper("raw")
    start, end = F.regexp_extract(u, r"\bPERFORM\b\s+([A-Z0-9-]+)\s+\bTHRU\b\s+([A-Z0-9-]+)", 1), F.regexp_extract(u, r"\bPERFORM\b\s+([A-Z0-9-]+)\s+\bTHRU\b\s+([A-Z0-9-]+)", 2)
    single = F.when(~F.contains(u, F.lit("THRU")), F.regexp_extract(u, _PERFORM, 1))
    jump = F.regexp_extract(u, r"\bGO\s+TO\b\s+([A-Z0-9-]+)", 1)
    none = F.lit(None).cast("string")
    reach = lambda kind, rank, dst, a=none, b=none: F.struct(F.lit(rank).alias("rank"), F.lit(kind).alias("type"), dst.alias("dst"), a.alias("range_start"), b.alias("range_end"))
    all_of = F.array(reach("CALL_RANGE", 0, start, start, end), reach("CALL_RANGE", 0, end, start, end), reach("CALL", 1, single), reach("JUMP", 2, jump))
    found = paragraph_lines.select("program", F.col("paragraph").alias("src"), "line_no", strip(F.col("raw")).alias("evidence"), F.explode(all_of).alias("r")).where("r.dst <> ''")
    best = found.groupBy("program", "src", F.col("r.dst").alias("dst")).agg(F.min_by(F.struct("r.type", "evidence", "r.range_start", "r.range_end"), F.struct("line_no", "r.rank")).alias("m"))
    named = edges.withColumn("src", paragraph_name(F.col("src"))).withColumn("dst", paragraph_name(F.col("dst")))
    joined = named.join(best, ["program", "src", "dst"], "left")
    return joined.select(*edges.columns, F.coalesce("m.type", F.lit("FALLTHROUGH")).alias("type"), "m.evidence", "m.range_start", "m.range_end")


def perform_ranges(paragraph_lines: DataFrame) -> DataFrame:
    """program, range_start, range_end, once each."""
    u = F.upper("raw")
    pattern = r"\bPERFORM\b\s+([A-Z0-9-]+)\s+\bTHRU\b\s+([A-Z0-9-]+)"
    rows = paragraph_lines.select("program", F.regexp_extract(u, pattern, 1).alias("range_start"), F.regexp_extract(u, pattern, 2).alias("range_end"))
    return rows.where("range_start <> ''").distinct()


def monitor_verbs(paragraph_lines: DataFrame) -> DataFrame:
    """program, paragraph, cics_ops: the verbs of its EXEC blocks in order, each once."""
    blocks = cobol.monitor_blocks(paragraph_lines, "raw", ("program", "paragraph"))
    verb = F.upper(F.regexp_extract("statement", r"(?i)\bEXEC\s+CICS\s+([A-Z]+)\b", 1))
    rows = blocks.withColumn("verb", verb).where(F.col("verb").isin(*fixed.MONITOR_VERBS))
    held = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("line_start", "verb"))), lambda x: x["verb"]))
    return rows.groupBy("program", "paragraph").agg(held.alias("cics_ops"))


def jump_conditions(paragraph_lines: DataFrame) -> DataFrame:
    """program, src, dst, condition of the jumps that depend on one."""
    held = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "raw"))), lambda x: x["raw"])
    paragraphs = paragraph_lines.groupBy("program", F.col("paragraph").alias("src")).agg(held.alias("lines"))
    # Only paragraphs with a jump and a branch go to Python.
    some = paragraphs.where(F.exists("lines", lambda x: x.rlike(r"(?i)\bGO\s+TO\b")) & F.exists("lines", lambda x: x.rlike(r"(?i)^\s*IF\b")))
    rows = some.select("program", "src", F.explode(branch_conditions_udf("lines")).alias("c"))
    return rows.select("program", "src", F.col("c.target").alias("dst"), F.col("c.condition").alias("condition"))


def bracketed(condition: Column) -> Column:
    """A compound condition that doesn't begin with a bracket gets one round it."""
    compound = F.upper(condition).rlike(" AND | OR | NOT ") & ~F.startswith(condition, F.lit("("))
    return F.when(compound, F.concat(F.lit("("), condition, F.lit(")"))).otherwise(condition)


def enriched(edges: DataFrame, paragraph_lines: DataFrame, order: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """edges with type, condition, range_start, range_end, cics_ops, evidence, range_flow_of.

    overrides(program, src, dst, type, condition, evidence) replace what was found for their pairs and add those
    that are missing: what is known of one program only is data, not code.
    """
    out = typed(edges, paragraph_lines)
    out = out.join(jump_conditions(paragraph_lines), ["program", "src", "dst"], "left")
    out = out.withColumn("condition", F.when(F.col("type") == "JUMP", bracketed(F.col("condition"))))
    out = out.join(monitor_verbs(paragraph_lines).withColumnRenamed("paragraph", "dst"), ["program", "dst"], "left")
    out = out.withColumn("cics_ops", F.when(F.col("type").isin("CALL", "CALL_RANGE"), F.col("cics_ops")))
    falls = out.where("type = 'FALLTHROUGH'").select("program", "src", "dst")
    flow = successive_in_ranges(falls, order, perform_ranges(paragraph_lines), key="program")
    flow = flow.groupBy("program", "src", "dst").agg(F.array_sort(F.collect_set(F.struct(F.col("range_start").alias("start"), F.col("range_end").alias("end")))).alias("range_flow_of"))
    out = out.join(flow, ["program", "src", "dst"], "left").withColumn("type", F.when(F.col("range_flow_of").isNotNull(), "RANGE_FLOW").otherwise(F.col("type")))
    names = ["program", "edge_no", "src", "dst", "type", "condition", "range_start", "range_end", "cics_ops", "evidence", "range_flow_of"]
    out = out.select(*names)
    if overrides is None:
        return out
    mine = overrides.select("program", "src", "dst", *[F.col(c).alias(f"o_{c}") for c in ("type", "condition", "evidence")], F.lit(True).alias("o"))
    both = out.join(mine, ["program", "src", "dst"], "full_outer")
    pick = lambda c: F.when(F.col("o"), F.col(f"o_{c}")).otherwise(F.col(c)).alias(c)
    return both.select(*[pick(c) if c in ("type", "condition", "evidence") else c for c in names])


#: Rounds of a search whose results stand in files of their own.
MERGE = 16


def reachable(edges: DataFrame, roots: DataFrame, max_rounds: int = 10_000) -> DataFrame:
    """program, node: all that roots(program, node) reach over edges(program, src, dst), the roots included.

    Each round joins only the newest nodes with the edges and keeps those not seen before; rounds are checkpointed,
    since a lost executor would otherwise repeat them all. What was seen is the union of the rounds' files, written
    anew only every MERGE rounds. As many rounds as the longest shortest path.
    """
    from .checkpoint import checkpointed

    edges = checkpointed(edges.select("program", "src", "dst").distinct())
    fresh = checkpointed(roots.select("program", "node").distinct())
    parts = [fresh]
    for _ in range(max_rounds):
        seen = functools.reduce(DataFrame.union, parts)
        step = fresh.join(edges, (fresh["program"] == edges["program"]) & (fresh["node"] == edges["src"])).select(fresh["program"], F.col("dst").alias("node")).distinct()
        fresh = checkpointed(step.join(seen, ["program", "node"], "left_anti"))
        if fresh.isEmpty():
            return seen
        parts = [*parts, fresh] if len(parts) < MERGE else [checkpointed(seen), fresh]
    raise RuntimeError(f"reachability did not settle in {max_rounds} rounds")


def reachable_by_program(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """The same for many graphs that are each small, such as one program's: one shuffle, a breadth-first search for each."""
    rows = edges.select("program", "src", "dst").unionByName(roots.select("program", F.lit(None).cast("string").alias("src"), F.col("node").alias("dst")))

    def search(own: pd.DataFrame) -> pd.DataFrame:
        next_of = defaultdict(list)
        for src, dst in own[["src", "dst"]].itertuples(index=False):
            next_of[src].append(dst)
        seen = dict.fromkeys(next_of[None])
        todo = deque(seen)
        while todo:
            for dst in next_of[todo.popleft()]:
                if dst not in seen:
                    seen[dst] = None
                    todo.append(dst)
        return pd.DataFrame({"program": own["program"].iloc[0], "node": list(seen)})

    return rows.groupBy("program").applyInPandas(search, "program string, node string")


def unreachable(nodes: DataFrame, reached: DataFrame) -> DataFrame:
    return nodes.join(reached, ["program", "node"], "left_anti")


def compare(left_nodes: DataFrame, left_edges: DataFrame, right_nodes: DataFrame, right_edges: DataFrame) -> DataFrame:
    """One row a graph (key): counts, recall, precision and F1 of nodes and edges, and status.

    nodes(key, node), edges(key, src, dst). Missing graphs give LEFT_ONLY or RIGHT_ONLY. Repeats count once.
    """
    tag = lambda n, e, side: n.select("key", F.lit("n").alias("what"), F.col("node").alias("a"), F.lit("").alias("b")).unionByName(
        e.select("key", F.lit("e").alias("what"), F.col("src").alias("a"), F.col("dst").alias("b"))
    ).select("*", F.lit(side == "l").alias("l"), F.lit(side == "r").alias("r"))
    return compare_items(tag(left_nodes, left_edges, "l").unionByName(tag(right_nodes, right_edges, "r")))


#: Items of a task of compare_items(), and the most tasks: up to this many, Spark writes a shuffle's files without holding rows.
PIECE_ITEMS, PIECES = 100_000, 200


def compare_items(items: DataFrame, count: int | None = None) -> DataFrame:
    """compare() of items(key, what, a, b, l, r): edges (what 'e') and nodes (any other), in any form, with the sides they are on.

    With ``count``, about how many items there are, they are dealt out first, into pieces that grow in number with the input
    and that the session's settings don't join: nothing is held before the shuffle, where nearly all edges differ, and
    a task holds its piece only.
    """
    if count is not None:
        items = items.repartition(min(PIECES, max(1, -(-count // PIECE_ITEMS))), "key", "what", "a", "b")
    each = items.groupBy("key", "what", "a", "b").agg(F.bool_or("l").alias("l"), F.bool_or("r").alias("r"))
    of = lambda what: F.col("what") == "e" if what == "e" else F.col("what") != "e"
    n = lambda what, c, name: F.count_if(of(what) & c).alias(name)
    l, r = F.col("l"), F.col("r")
    out = each.groupBy("key").agg(
        F.bool_or("l").alias("in_left"), F.bool_or("r").alias("in_right"),
        *[n(w, c, f"{s}_{name}") for w, name in (("n", "node_count"), ("e", "edge_count")) for s, c in (("left", l), ("right", r), ("common", l & r))],
        n("n", l & ~r, "missing_nodes"), n("n", r & ~l, "extra_nodes"), n("e", l & ~r, "missing_edges"), n("e", r & ~l, "extra_edges"),
    )
    for w in ("node", "edge"):
        common, left, right = (F.col(f"{s}_{w}_count") for s in ("common", "left", "right"))
        out = out.withColumn(f"{w}_recall", ratio(common, left)).withColumn(f"{w}_precision", ratio(common, right))
        out = out.withColumn(f"{w}_f1", f1(F.col(f"{w}_recall"), F.col(f"{w}_precision")))
    relation = set_relation(F.col("missing_nodes") + F.col("missing_edges"), F.col("extra_nodes") + F.col("extra_edges"))
    status = F.when(~F.col("in_right"), "LEFT_ONLY").when(~F.col("in_left"), "RIGHT_ONLY").otherwise(relation)
    return out.withColumn("status", status).drop("in_left", "in_right")


#: Statuses, worst first.
WORST = ("LEFT_ONLY", "RIGHT_ONLY", "DIFFERENT", "LEFT_SUPERSET", "RIGHT_SUPERSET", "EXACT")


def worst_first(compared: DataFrame, k: int) -> DataFrame:
    rank = F.array_position(F.array(*map(F.lit, WORST)), F.col("status"))
    return compared.orderBy(rank, "edge_f1", "node_f1", "key").limit(k)


def scorecard(compared: DataFrame, left: str = "left", right: str = "right") -> DataFrame:
    """One row: totals over all graphs of both sides, micro-averaged scores, alignment, profile and hint."""
    from ..functions.classify import comparison_profile, score_hint

    paired = ~F.col("status").isin("LEFT_ONLY", "RIGHT_ONLY")
    total = lambda c: F.coalesce(F.sum(F.when(paired, F.col(c))), F.lit(0)).alias(c)
    names = [f"{s}_{w}_count" for w in ("node", "edge") for s in ("left", "right", "common")]
    out = compared.agg(*map(total, names), *[F.count_if(F.col("status") == s).alias(f"n_{s.lower()}") for s in WORST])
    for w in ("node", "edge"):
        out = out.withColumn(f"{w}_recall", ratio(F.col(f"common_{w}_count"), F.col(f"left_{w}_count"))).withColumn(f"{w}_precision", ratio(F.col(f"common_{w}_count"), F.col(f"right_{w}_count")))
        out = out.withColumn(f"{w}_f1", f1(F.col(f"{w}_recall"), F.col(f"{w}_precision")))
    out = out.withColumn("alignment", (F.col("node_f1") + F.col("edge_f1")) / 2)
    r, p = F.col("edge_recall"), F.col("edge_precision")
    out = out.withColumn("profile", comparison_profile(r, p, F.col("n_left_only"), F.col("n_right_only"), left, right))
    return out.withColumn("hint", score_hint(F.col("alignment"), r, p, left, right))


def condition_quality(edges: DataFrame) -> DataFrame:
    """One row: edges, conditioned edges, and the share of conditions with each issue."""
    from ..functions.classify import condition_issues

    rows = edges.withColumn("issues", condition_issues(F.col("condition")))
    has = F.coalesce(F.col("condition") != "", F.lit(False))
    n = F.count_if(has)
    rate = lambda issue: F.round(ratio(F.count_if(has & F.array_contains("issues", issue)), n), 6).alias(f"{issue}_rate")
    return rows.agg(F.count(F.lit(1)).alias("n_edges"), n.alias("n_conditions"), *map(rate, ("unbalanced", "many_parens", "malformed", "duplicate_or_term")))


def screen_actions(edges: DataFrame) -> DataFrame:
    """program, context, trigger, key, other_keys, target, edge_type, evidence of the edges that a key press decides."""
    u = F.upper("condition")
    rows = edges.where(F.contains(u, F.lit("EIBAID")) | F.contains(u, F.lit("DFH")))
    other = F.contains(u, F.lit("EIBAID")) & F.contains(u, F.lit("NOT"))
    key = F.coalesce(F.nullif(F.regexp_extract(u, r"EIBAID\s*=\s*([A-Z0-9-]+)", 1), F.lit("")), F.lit("UNKNOWN"))
    names = F.array_sort(F.array_distinct(F.regexp_extract_all(u, F.lit("(DFH[A-Z0-9]+)"), 1)))
    return rows.select(
        "program", F.col("src").alias("context"), F.col("condition").alias("trigger"), F.when(other, "OTHER").otherwise(key).alias("key"),
        F.when(other, names).otherwise(F.array().cast("array<string>")).alias("other_keys"), F.col("dst").alias("target"), F.col("type").alias("edge_type"), "evidence",
    )


def screen_maps(lines: DataFrame, programs: DataFrame) -> DataFrame:
    """program, map, mapset, operations, options, evidence of the maps that programs send and receive."""
    rows = cobol.fixed_columns(lines).where(~F.col("indicator").isin("*", "/"))
    s, u = F.col("statement"), F.upper("statement")
    name = lambda word: F.upper(F.regexp_extract(s, rf"""(?i){word}\s*\(\s*['"]?([A-Z0-9-]+)['"]?\s*\)""", 1))
    blocks = cobol.monitor_blocks(rows).where(u.rlike("SEND|RECEIVE")).join(programs, "file")
    options = F.filter(F.array(*map(F.lit, ("CURSOR", "DATAONLY", "ERASE"))), lambda o: F.contains(u, o))
    rows = blocks.select("program", "line_start", name("MAP").alias("map"), name("MAPSET").alias("mapset"), strip(s).alias("evidence"), F.when(F.concat(F.lit(" "), u, F.lit(" ")).contains(" SEND "), "SEND").otherwise("RECEIVE").alias("operation"), options.alias("options")).where("map <> ''")
    return rows.groupBy("program", "map", "mapset").agg(
        F.array_sort(F.collect_set("operation")).alias("operations"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("options")))).alias("options"),
        F.transform(F.array_sort(F.collect_list(F.struct("line_start", "evidence"))), lambda x: x["evidence"]).alias("evidence"),
    )
