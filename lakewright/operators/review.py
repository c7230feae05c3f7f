"""Review documents of programs: variables, assignments, calls, screens, dead code, unused copybooks, job files; and the run's report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import joined_id, short_blake
from ..functions.text import citation, list_or_none, safe_name
from .documents import document
from .relational import sorted_set

_P = F.col


def _by_program(rows: DataFrame, order: list[str], fields: list[str], name: str) -> DataFrame:
    """program and an array of structs in order: one program's facts, which are bounded by its text."""
    held = F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("o"), F.struct(*fields).alias("v"))))
    return rows.groupBy("program").agg(F.transform(held, lambda x: x["v"]).alias(name))


def variable_documents(records: DataFrame) -> DataFrame:
    """One document a variable of dataflow.variable_records()."""
    p, v = _P("program"), _P("variable")
    text = F.format_string("%s variable %s (origin %s). Defined in: %s. Modified in: %s. Used in: %s. Controls flow: %s.", p, v, "origin", list_or_none(_P("defined_in")), list_or_none(_P("modified_in")), list_or_none(_P("used_in")), F.when(_P("controls_flow"), "yes").otherwise("no"))
    names = ["variable", "origin", "defined_in", "modified_in", "used_in", "controls_flow", "fanout_nodes", "write_sites", "read_sites", "control_sites"]
    meta = F.struct(F.lit("dataflow").alias("source"), "origin", "controls_flow", F.size("write_sites").alias("writes"), F.size("read_sites").alias("reads"), F.size("control_sites").alias("controls"), safe_name(v, default="VAR").alias("name"))
    return document(records, short_blake(F.concat_ws("|", p, v)), F.lit("dataflow.variable"), p, F.format_string("%s variable %s", p, v), text, F.struct(*names), meta)


def used_variables_documents(records: DataFrame) -> DataFrame:
    """One document a program with its used variables."""
    rows = _by_program(records, ["variable"], ["variable", "origin", "controls_flow", "defined_in", "modified_in", "used_in"], "variables")
    kind = "dataflow.used_variables"
    return document(rows, joined_id(_P("program"), F.lit(kind)), F.lit(kind), _P("program"), F.format_string("%s used variables", "program"), F.format_string("%s uses %d variable(s).", "program", F.size("variables")), F.struct("variables"), F.struct(F.size("variables").alias("count")))


def literal_documents(assignments: DataFrame, shown: int = 80) -> DataFrame:
    """One document a program of dataflow.literal_assignments(), by line, target and literal."""
    names = [c for c in assignments.columns if c != "program"]
    rows = _by_program(assignments, ["line", "target_variable", "literal_raw"], names, "assignments")
    say = lambda a: F.concat(a["target_variable"], F.lit(" gets "), a["literal_raw"], F.lit(" in "), a["paragraph"], F.lit(" line "), F.coalesce(a["line"].cast("string"), F.lit("unknown")), F.lit("."))
    text = F.concat(F.format_string("%s literal and forced value assignments. ", "program"), F.array_join(F.transform(F.slice("assignments", 1, shown), say), " "))
    n = lambda flag: F.size(F.filter("assignments", lambda a: a[flag])).alias(f"{flag}_count")
    meta = F.struct(F.size("assignments").alias("count"), *map(n, ("controls_flow", "screen_or_map_field", "call_commarea_field")))
    kind = "dataflow.literal_assignments"
    return document(rows, joined_id(_P("program"), F.lit(kind)), F.lit(kind), _P("program"), F.format_string("%s literal assignments", "program"), text, F.struct("assignments"), meta)


def call_documents(calls: DataFrame, details: DataFrame) -> DataFrame:
    """One document a program of its calls with what is written before and read after them."""
    held = F.array_sort(F.collect_list(F.struct("parameter", "variable", "side", "place", "line", "paragraph", "statement")))
    rows = calls.join(details.groupBy("program", "call_id").agg(held.alias("details")), ["program", "call_id"], "left")
    rows = _by_program(rows, ["line_start", "target"], ["call_id", "target", "call_type", "paragraph", "line_start", "line_end", "statement", "parameters", "commarea", "length", "details"], "calls")
    used = lambda c: F.when(F.size(c["parameters"]) > 0, F.array_join(c["parameters"], ", ")).otherwise("no explicit parameter")
    say = lambda c: F.concat(c["target"], F.lit(" via "), c["call_type"], F.lit(" uses "), used(c), F.lit(" in "), c["paragraph"], F.lit(" line "), c["line_start"].cast("string"), F.lit("."))
    text = F.concat(F.format_string("%s outgoing call parameters. ", "program"), F.array_join(F.transform("calls", say), " "))
    meta = F.struct(F.size("calls").alias("count"), F.size(F.filter("calls", lambda c: F.size(c["parameters"]) > 0)).alias("with_parameters"))
    kind = "architecture.call_parameters"
    return document(rows, joined_id(_P("program"), F.lit(kind)), F.lit(kind), _P("program"), F.format_string("%s call parameters", "program"), text, F.struct("calls"), meta)


def navigation_documents(actions: DataFrame, maps: DataFrame) -> DataFrame:
    """One document a program of its keys, targets, maps and screens."""
    acts = _by_program(actions, ["context", "trigger"], ["context", "trigger", "key", "other_keys", "target", "edge_type", "evidence"], "actions")
    shown = _by_program(maps, ["map", "mapset"], ["map", "mapset", "operations", "options", "evidence"], "maps")
    rows = acts.join(shown, "program", "full_outer")
    keys = F.array_sort(F.array_distinct(F.transform(F.filter("actions", lambda a: ~a["key"].isin("OTHER", "UNKNOWN")), lambda a: a["key"])))
    rows = rows.withColumn("keys", keys)
    first = lambda k: F.get(F.transform(F.filter("actions", lambda a: a["key"] == k), lambda a: a["target"]), F.lit(0))
    told_keys = F.when(F.size("keys") > 0, F.concat(F.lit("Keys: "), F.array_join(F.transform("keys", lambda k: F.concat(k, F.lit(" -> "), first(k))), ", ")))
    told_maps = F.when(F.size("maps") > 0, F.concat(F.lit("Maps: "), F.array_join(F.transform("maps", lambda m: F.concat(m["map"], F.lit("/"), m["mapset"], F.lit(" ("), F.array_join(m["operations"], "/"), F.lit(")"))), ", ")))
    screens = F.array_sort(F.array_distinct(F.transform("maps", lambda m: F.when(m["mapset"] == "", m["map"]).otherwise(F.concat(m["map"], F.lit("/"), m["mapset"])))))
    text = F.concat_ws(" ", F.format_string("CICS UI navigation for %s.", "program"), told_keys, told_maps)
    n = lambda c: F.greatest(F.size(F.coalesce(c, F.array())), F.lit(0))
    meta = F.struct(n("actions").alias("actions"), n("keys").alias("keys"), n("maps").alias("maps"))
    return document(rows, short_blake(F.concat_ws("|", "program", F.lit("ui.cics.navigation"))), F.lit("ui.cics.navigation"), _P("program"), F.format_string("%s CICS UI navigation", "program"), text, F.struct("actions", "maps", screens.alias("screens")), meta)


def graph_documents(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One document a program's control-flow graph."""
    n = nodes.groupBy("program").agg(sorted_set("node").alias("nodes"))
    e = _by_program(edges, ["edge_no"], ["src", "dst", "type"], "edges")
    rows = n.join(e, "program", "left")
    text = F.format_string("Control flow graph of %s: %d nodes, %d edges.", "program", F.size("nodes"), F.greatest(F.size("edges"), F.lit(0)))
    kind = "controlflow.cfg"
    return document(rows, joined_id(_P("program"), F.lit(kind)), F.lit(kind), _P("program"), F.format_string("%s control flow graph", "program"), text, F.struct("nodes", "edges"), F.struct(F.size("nodes").alias("nodes")))


def dead_code_documents(programs: DataFrame, comments: DataFrame, nodes: DataFrame, reached: DataFrame) -> DataFrame:
    """One document a program: disabled code in comments, and nodes that nothing reaches."""
    off = comments.where("classification = 'commented_out_code'")
    off = _by_program(off.withColumn("citation", citation(_P("file"), _P("line_no"), _P("text"))), ["line_no"], ["line_no", "paragraph", "text", "citation"], "disabled")
    lost = nodes.join(reached, ["program", "node"], "left_anti").groupBy("program").agg(sorted_set("node").alias("unreachable"))
    n = reached.groupBy("program").agg(F.count(F.lit(1)).alias("reachable"))
    rows = programs.select("program").distinct().join(off, "program", "left").join(lost, "program", "left").join(n, "program", "left")
    size = lambda c: F.greatest(F.size(c), F.lit(0))
    text = F.format_string("%s has %d disabled code comment(s) and %d unreachable node(s).", "program", size("disabled"), size("unreachable"))
    meta = F.struct(size("disabled").alias("disabled_count"), size("unreachable").alias("unreachable_count"), F.coalesce("reachable", F.lit(0)).alias("reachable_count"))
    kind = "quality.dead_code"
    return document(rows, joined_id(_P("program"), F.lit(kind)), F.lit(kind), _P("program"), F.format_string("%s dead code", "program"), text, F.struct("disabled", "unreachable"), meta)


def unused_copybook_documents(copybooks: DataFrame, evidence: DataFrame) -> DataFrame:
    """One document a program: copybooks with and without a sign of use."""
    seen = evidence.groupBy("program", "name").agg(sorted_set("evidence").alias("evidence"))
    rows = copybooks.join(seen, ["program", "name"], "left").groupBy("program").agg(sorted_set(F.when(F.col("evidence").isNull(), F.col("name"))).alias("unused"), sorted_set(F.when(F.col("evidence").isNotNull(), F.col("name"))).alias("used"))
    text = F.format_string("%s has %d copybook(s) without evidence of use: %s.", "program", F.size("unused"), list_or_none(_P("unused")))
    kind = "architecture.unused_copybooks"
    return document(rows, joined_id(_P("program"), F.lit(kind)), F.lit(kind), _P("program"), F.format_string("%s unused copybooks", "program"), text, F.struct("unused", "used"), F.struct(F.size("unused").alias("unused_count")))


def screen_documents(lineage: DataFrame) -> DataFrame:
    """One document a program of its screen fields' families."""
    rows = _by_program(lineage, ["family"], ["family", "members", "n_writes", "n_reads", "n_controls", "first_line"], "fields")
    kind = "screen_field_lineage"
    return document(rows, joined_id(_P("program"), F.lit(kind)), F.lit(kind), _P("program"), F.format_string("%s screen field lineage", "program"), F.format_string("%s has %d screen field(s).", "program", F.size("fields")), F.struct("fields"), F.struct(F.size("fields").alias("count")))


def job_file_documents(steps: DataFrame, datasets: DataFrame) -> DataFrame:
    """One document a program that jobs run: its steps with the datasets of each access."""
    rows = steps.where("program IS NOT NULL").join(datasets.withColumnRenamed("step_seq", "seq"), ["file", "seq"], "left")
    rows = _by_program(rows, ["job", "seq"], ["job", "step", "reads", "writes", "deletes", "controls", "unknowns", "sysouts"], "steps")
    kind = "jcl.file_io"
    return document(rows, joined_id(_P("program"), F.lit(kind)), F.lit(kind), _P("program"), F.format_string("%s job file use", "program"), F.format_string("%s runs in %d job step(s).", "program", F.size("steps")), F.struct("steps"), F.struct(F.size("steps").alias("step_count")))


def next_actions(reasons: DataFrame, index_notes: Column | None = None) -> DataFrame:
    """action: what to do, most frequent first; one line that all is ready if there is nothing."""
    told = reasons.select(F.format_string("%s: %d program(s)", "note", "n").alias("action"), F.col("n"))
    ready = reasons.agg(F.count(F.lit(1)).alias("k")).where("k = 0").select(F.lit("Factory output is ready for vector DB ingestion.").alias("action"), F.lit(0).cast("long").alias("n"))
    return told.unionByName(ready)
