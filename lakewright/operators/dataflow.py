"""Data flow: what statements write and read, variables with their sites, and what is derived from them.

Sites are a long table (program, variable, kind, paragraph, line, statement); lists are nested at the edge only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.classify import starts
from ..functions.text import commarea_prefix, flow_targets, identifiers, is_data_word, screen_family, strip, unquote_literal
from ..sources import cobol
from .relational import prefix_join, sorted_set, top_k_per_group

KINDS = ("write", "read", "control")


def _after(u: Column, word: str) -> Column:
    """What follows the first occurrence of word."""
    return F.substr(u, F.instr(u, F.lit(word)) + F.lit(len(word)))


def writes_reads(statement: Column) -> tuple[Column, Column]:
    """(written, read) variables of a statement, by its verb; each an array without repeats."""
    u = F.upper(strip(statement))
    verb = F.substring_index(u, " ", 1)
    rest = F.substr(u, F.length(verb) + 1)
    has = lambda w: F.contains(u, F.lit(w))
    before = lambda w: F.substring_index(rest, w, 1)
    none = F.array().cast("array<string>")
    ids = identifiers
    first = F.slice(ids(rest), 1, 1)
    move = has(" TO ")
    exec_writes = F.when(has(" RECEIVE ") & has(" INTO "), ids(_after(u, " INTO "))).otherwise(none)
    writes = (
        F.when((verb == "MOVE") & move, ids(_after(rest, " TO ")))
        .when(verb == "COMPUTE", first)
        .when(verb.isin("ADD", "SUBTRACT", "MULTIPLY", "DIVIDE"), F.when(move, ids(_after(rest, " TO "))).when(has(" GIVING "), ids(_after(u, " GIVING "))).otherwise(none))
        .when(verb == "SET", F.when(move, ids(before(" TO "))).when(has(" UP BY "), ids(before(" UP BY "))).otherwise(none))
        .when(verb == "INITIALIZE", ids(rest))
        .when(verb == "EXEC", exec_writes)
        .otherwise(none)
    )
    reads = (
        F.when(verb.isin("GO", "GOTO", "GO-TO"), none)
        .when(verb == "PERFORM", F.when(has(" VARYING "), ids(u)).otherwise(none))
        .when(verb == "MOVE", F.when(move, ids(before(" TO "))).otherwise(none))
        .when(verb == "COMPUTE", F.when(has("="), ids(_after(u, "="))).otherwise(F.slice(ids(rest), 2, 1 << 20)))
        .when(verb.isin("ADD", "SUBTRACT", "MULTIPLY", "DIVIDE"), ids(rest))
        .when(verb == "SET", F.when(move, ids(_after(rest, " TO "))).when(has(" UP BY "), ids(rest)).otherwise(none))
        .when(verb == "INITIALIZE", none)
        .when(verb == "EXEC", F.array_except(ids(u), exec_writes))
        .when(verb.isin("CALL", "LINK", "XCTL"), F.when(has(" USING "), ids(_after(u, " USING "))).otherwise(none))
        .otherwise(ids(u))
    )
    return F.array_distinct(writes), F.array_distinct(reads)


def is_condition(statement: Column) -> Column:
    return F.upper(strip(statement)).rlike("^(IF|EVALUATE|WHEN) ")


def variables(declared: DataFrame, stmts: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """program, variable, origin: declared or used names that are no paragraphs; undeclared ones by their prefix.

    declared(program, variable, origin), stmts(program, statement), paragraphs(program, paragraph).
    """
    used = stmts.select("program", F.explode(F.array_distinct(identifiers(F.col("statement")))).alias("variable")).distinct()
    known = declared.groupBy("program", "variable").agg(F.min_by("origin", F.col("origin") == "UNKNOWN").alias("origin"))
    names = used.join(known, ["program", "variable"], "full_outer").where(is_data_word(F.col("variable")))
    names = names.join(paragraphs.select("program", F.col("paragraph").alias("variable")), ["program", "variable"], "left_anti")
    v = F.col("variable")
    guessed = F.when(starts(v, "TWCOB-"), "COMMAREA").when(starts(v, "DFH"), "CICS_CONST").when(starts(v, "EIB"), "CICS_EIB").otherwise("UNKNOWN")
    return names.select("program", "variable", F.coalesce(F.nullif("origin", F.lit("UNKNOWN")), guessed).alias("origin"))


def sites(stmts: DataFrame, vars_: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """program, variable, kind (write, read, control), paragraph, line, statement, targets, once each.

    A variable that a statement writes isn't also read there. Conditions of edges count as control sites of line -1.
    One explode of three arrays from one pass over the statements, then an equi-join with the variables.
    """
    writes, reads = writes_reads(F.col("statement"))
    condition = F.when(is_condition(F.col("statement")), F.array_distinct(identifiers(F.col("statement")))).otherwise(F.array().cast("array<string>"))
    own = stmts.where(~F.col("paragraph").isin(*sorted(fixed.DATAFLOW_WORDS))).select("program", "paragraph", F.col("line_start").alias("line"), "statement", writes.alias("w"), reads.alias("r"), condition.alias("c"))
    kinds = F.map_from_arrays(F.array(*map(F.lit, KINDS)), F.array("w", F.array_except("r", "w"), "c"))
    long = own.select("program", "paragraph", "line", strip(F.col("statement")).alias("statement"), F.explode(kinds).alias("kind", "names"))
    targets = F.when(F.col("kind") == "control", F.array_sort(flow_targets(F.col("statement")))).otherwise(F.array().cast("array<string>"))
    long = long.select("program", F.explode("names").alias("variable"), "kind", "paragraph", "line", "statement", targets.alias("targets"))
    if edges is not None:
        told = edges.where("condition <> ''").select(
            "program", F.explode(F.array_distinct(identifiers(F.col("condition")))).alias("variable"), F.lit("control").alias("kind"), F.col("src").alias("paragraph"),
            F.lit(-1).alias("line"), F.col("condition").alias("statement"), F.array("dst").alias("targets"),
        )
        long = long.unionByName(told)
    return long.join(vars_.select("program", "variable"), ["program", "variable"]).groupBy("program", "variable", "kind", "paragraph", "line", "statement").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("targets")))).alias("targets"))


def variable_records(vars_: DataFrame, sites_: DataFrame) -> DataFrame:
    """One row a variable: defined_in (paragraph of its first write), modified_in, used_in, controls_flow, fanout_nodes, sites by kind."""
    kind = lambda k, v: F.when(F.col("kind") == k, v)
    site = F.struct("line", "paragraph", "statement")
    nested = lambda k: F.array_sort(F.collect_list(kind(k, site))).alias(f"{k}_sites")
    words = sorted(fixed.DATAFLOW_WORDS | {"TOP"})
    fanout = F.filter(F.array_distinct(F.flatten(F.collect_list(kind("control", F.col("targets"))))), lambda t: ~t.isin(*words))
    grouped = sites_.groupBy("program", "variable").agg(
        F.min_by("paragraph", kind("write", F.struct("line", "paragraph"))).alias("first_write"),
        sorted_set(kind("write", F.col("paragraph"))).alias("modified_in"), sorted_set(kind("read", F.col("paragraph"))).alias("used_in"),
        F.coalesce(F.bool_or(F.col("kind") == "control"), F.lit(False)).alias("controls_flow"), F.array_sort(fanout).alias("fanout_nodes"), *map(nested, KINDS),
    )
    out = vars_.join(grouped, ["program", "variable"], "left")
    empty = F.array().cast("array<string>")
    none = F.array().cast("array<struct<line:int,paragraph:string,statement:string>>")
    return out.select(
        "program", "variable", "origin", F.when(F.col("first_write").isNotNull(), F.array("first_write")).otherwise(empty).alias("defined_in"),
        *[F.coalesce(c, empty).alias(c) for c in ("modified_in", "used_in", "fanout_nodes")], F.coalesce("controls_flow", F.lit(False)).alias("controls_flow"),
        *[F.coalesce(f"{k}_sites", none).alias(f"{k}_sites") for k in KINDS],
    )


def used(vars_: DataFrame, sites_: DataFrame) -> DataFrame:
    """Variables with a site of any kind: a semi-join."""
    return vars_.join(sites_.select("program", "variable").distinct(), ["program", "variable"], "left_semi")


def target_flags(variable: Column, origin: Column) -> tuple[Column, Column]:
    """(screen_or_map_field, call_commarea_field)."""
    v = F.upper(variable)
    return starts(F.upper(F.coalesce(origin, F.lit(""))), "COPY:PDCBVCM") | v.rlike("^M[0-9][A-Z0-9-]+[A-Z]$"), starts(v, *fixed.COMMAREA_PREFIXES)


_MOVE = r"""(?i)\bMOVE\s+('[^']*'|"[^"]*"|[+-]?[0-9]+(?:\.[0-9]+)?)\s+TO\s+([A-Z0-9-]+)\b"""


def literal_assignments(sites_: DataFrame, vars_: DataFrame, control: DataFrame) -> DataFrame:
    """program, target_variable, literal, literal_raw, paragraph, line, statement, origin and flags of the moved literals, once each.

    control(program, variable, controls_flow).
    """
    target = F.upper(F.regexp_extract("statement", _MOVE, 2))
    rows = sites_.where("kind = 'write'").withColumn("literal_raw", F.regexp_extract("statement", _MOVE, 1)).where((target == F.col("variable")) & (target != ""))
    rows = rows.dropDuplicates(["program", "variable", "literal_raw", "paragraph", "line"])
    rows = rows.join(vars_.select("program", "variable", "origin"), ["program", "variable"], "left").join(control.select("program", "variable", "controls_flow"), ["program", "variable"], "left")
    screen, commarea = target_flags(F.col("variable"), F.col("origin"))
    return rows.select(
        "program", F.col("variable").alias("target_variable"), unquote_literal(F.col("literal_raw")).alias("literal"), "literal_raw", "paragraph", F.nullif("line", F.lit(0)).alias("line"),
        "statement", "origin", F.coalesce("controls_flow", F.lit(False)).alias("controls_flow"), screen.alias("screen_or_map_field"), commarea.alias("call_commarea_field"),
    )


def outgoing_calls(terminated: DataFrame) -> DataFrame:
    """terminated statements' calls: call_type, target, parameters, commarea, length with paragraph and lines."""
    s = F.col("statement")
    blocks = F.regexp_extract_all(s, F.lit(r"(?i)\b(EXEC\s+CICS\s+(?:LINK|XCTL)\b.*?\bEND-EXEC)\b"), 1)
    in_block = lambda word: F.nullif(F.upper(F.regexp_extract("block", rf"(?i)\b{word}\s*\(\s*([A-Z0-9-]+)\s*\)", 1)), F.lit(""))
    own = terminated.select("*", F.explode(blocks).alias("block"))
    target = F.regexp_extract("block", r"""(?i)\bPROGRAM\s*\(\s*('[^']+'|"[^"]+"|[A-Z0-9-]+)\s*\)""", 1)
    linked = own.where(target != "").select(
        "file", "paragraph", "line_start", "line_end", "statement", F.concat(F.lit("CICS"), F.upper(F.regexp_extract("block", r"(?i)CICS\s+(LINK|XCTL)", 1))).alias("call_type"),
        unquote_literal(target).alias("target"), F.array_compact(F.array(in_block("COMMAREA"))).alias("parameters"), in_block("COMMAREA").alias("commarea"), in_block("LENGTH").alias("length"),
    )
    pattern = r"""(?i)\bCALL\s+('[^']+'|"[^"]+"|[A-Z0-9-]+)\s+USING\s+(.+?)(?:\.|$)"""
    using = F.filter(F.transform(F.split(F.regexp_extract(s, pattern, 2), r"\s+"), lambda x: F.upper(F.rtrim(x, F.lit(".")))), lambda x: (x != "") & ~x.isin("BY", "REFERENCE", "CONTENT", "VALUE"))
    none = F.lit(None).cast("string")
    called = terminated.where(s.rlike(pattern)).select(
        "file", "paragraph", "line_start", "line_end", "statement", F.lit("CALL").alias("call_type"), F.upper(unquote_literal(F.regexp_extract(s, pattern, 1))).alias("target"),
        using.alias("parameters"), none.alias("commarea"), none.alias("length"),
    )
    return linked.unionByName(called)


def call_parameters(calls: DataFrame, sites_: DataFrame, around: int = 5) -> DataFrame:
    """program, call_id, parameter, field_prefix, variable, side (writes_before, reads_after), place, line, paragraph, statement.

    Each parameter's fields by prefix (cuts of the name, equi-joined), with the last writes up to the call and the first reads from it.
    """
    each = calls.select("program", "call_id", F.col("line_start").alias("call_line"), F.explode("parameters").alias("parameter")).withColumn("field_prefix", commarea_prefix(F.col("parameter")))
    own = sites_.where("kind IN ('write', 'read')").withColumnRenamed("program", "p")
    met = prefix_join(own, each, "variable", "field_prefix").where("p = program").drop("p")
    writes = met.where("kind = 'write' AND line <= call_line").withColumn("side", F.lit("writes_before")).withColumn("near", -F.col("line"))
    reads = met.where("kind = 'read' AND line >= call_line").withColumn("side", F.lit("reads_after")).withColumn("near", F.col("line"))
    both = top_k_per_group(writes.unionByName(reads), ["program", "call_id", "parameter", "variable", "side"], ["near", "statement"], around, "place")
    return both.select("program", "call_id", "parameter", "field_prefix", "variable", "side", "place", "line", "paragraph", "statement")


def screen_lineage(vars_: DataFrame, sites_: DataFrame, screen_copybooks: DataFrame) -> DataFrame:
    """program, family, members, lines, statements of the screen fields: those declared by copybooks(program, name) of screens."""
    of = F.regexp_extract("origin", "^COPY:(.*)$", 1)
    own = vars_.withColumn("name", of).join(screen_copybooks, ["program", "name"], "left_semi").withColumn("family", screen_family(F.col("variable")))
    found = own.join(sites_, ["program", "variable"], "left")
    return found.groupBy("program", "family").agg(
        sorted_set("variable").alias("members"), F.count_if(F.col("kind") == "write").alias("n_writes"), F.count_if(F.col("kind") == "read").alias("n_reads"),
        F.count_if(F.col("kind") == "control").alias("n_controls"), F.min(F.when(F.col("line") > 0, F.col("line"))).alias("first_line"),
    )


def first_site_line(sites_: DataFrame) -> DataFrame:
    """program, variable, line: the first valid line, writes before reads before control sites."""
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    return sites_.where("line > 0").groupBy("program", "variable").agg(F.min_by("line", F.struct(rank, "line")).alias("line"))


def copybook_evidence(copybooks: DataFrame, vars_: DataFrame, sites_: DataFrame) -> DataFrame:
    """program, name, evidence: how a copybook is seen in use, as origin, as a name's prefix, or as a name in a statement; each once."""
    by_origin = vars_.where("origin LIKE 'COPY:%'").select("program", F.regexp_extract("origin", "^COPY:(.*)$", 1).alias("name"), F.concat(F.lit("declares "), "variable").alias("evidence"))
    named = prefix_join(vars_.select(F.col("program").alias("p"), "variable"), copybooks, "variable", "name").where("p = program").select("program", "name", F.concat(F.lit("names "), "variable").alias("evidence"))
    return by_origin.unionByName(named).join(copybooks.select("program", "name"), ["program", "name"], "left_semi").distinct()


def unused_copybooks(copybooks: DataFrame, evidence: DataFrame) -> DataFrame:
    return copybooks.join(evidence.select("program", "name").distinct(), ["program", "name"], "left_anti")


def program_dataflow(lines: DataFrame, programs: DataFrame, copybook_lines: DataFrame | None = None, edges: DataFrame | None = None) -> dict[str, DataFrame]:
    """statements, paragraphs, declared, variables and sites of program text, all keyed by program."""
    stmts = cobol.statements(lines)
    proc = cobol.with_paragraphs(cobol.procedure_statements(stmts), F.lit("TOP")).join(programs, "file")
    name = F.nullif(F.regexp_extract(F.upper("statement"), fixed.PARAGRAPH, 1), F.lit(""))
    labels = cobol.procedure_statements(stmts).join(programs, "file").select("program", name.alias("paragraph")).where("paragraph IS NOT NULL")
    labels = labels.where(~F.col("paragraph").isin(*sorted(fixed.DATAFLOW_WORDS))).distinct()
    declared = cobol.declarations(stmts).join(programs, "file").select("program", "variable", "origin")
    if copybook_lines is not None:
        from ..functions.text import path_stem

        copied = cobol.copybook_declarations(cobol.statements(copybook_lines), path_stem(F.col("file")))
        # A program has the fields of the copybooks that it names, unless it declares them itself.
        refs = cobol.copy_references(lines).join(programs, "file").select("program", F.concat(F.lit("COPY:"), "copybook").alias("origin"))
        brought = refs.join(copied.select("variable", "origin"), "origin").select("program", "variable", "origin")
        declared = declared.unionByName(brought.join(declared, ["program", "variable"], "left_anti"))
    vars_ = variables(declared, proc, labels)
    return {"statements": proc, "paragraphs": labels, "declared": declared, "variables": vars_, "sites": sites(proc, vars_, edges)}


def shared_numbering(df: DataFrame, key: str, order: list[str], into: str) -> DataFrame:
    return df.withColumn(into, F.row_number().over(Window.partitionBy(key).orderBy(*order)))
