"""Queries of program text, job scripts and records over small fixtures; SQL where it can say the same."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from ..functions import classify, fixed, text
from ..functions.conditions import simplified_udf
from ..functions.ids import comment_id, short_blake
from ..operators import comments as comment_ops
from ..operators import dataflow, graph, jobs, maps, quality, relational, review, rules
from ..operators import documents as document_ops
from ..operators import index as index_ops
from ..sources import cobol, documents, facts, jcl
from ..sources.text import program_names
from . import fixture_sql, program
from .fixtures import frame, sql

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if (told := fixture_sql.SQL.get(fn.__name__) if oracle is None else oracle) is not None:
            SQL[fn.__name__] = told
        return fn

    return add


def _joined(df, *columns):
    """Array columns as text, so that both engines hash them alike."""
    for c in columns:
        df = df.withColumn(c, F.array_join(c, ","))
    return df


# --- classification chains ---------------------------------------------------------------------------


@query(f"""WITH {sql('fx_copybooks')}, n AS (SELECT name, upper(trim(name)) AS n FROM fx_copybooks),
c AS (SELECT name, CASE WHEN starts_with(n, 'DFH') THEN 'ui_cics:0.95'
 WHEN n = 'SQLCA' OR starts_with(n, 'PDPSQL') OR starts_with(n, 'PDWSQL') OR ends_with(n, 'SQLER') OR starts_with(n, 'SQL') THEN 'sql:0.85'
 WHEN contains(n, 'ABEND') OR starts_with(n, 'PDI') THEN 'error_handling:0.75' WHEN contains(n, 'UTI') THEN 'utilities:0.65'
 WHEN contains(n, 'SAV') OR contains(n, 'TWA') THEN 'state_context:0.55' WHEN contains(n, 'SEMA') THEN 'utilities:0.6'
 WHEN starts_with(n, 'PD') OR starts_with(n, 'PR') OR starts_with(n, 'PX') THEN 'business:0.45' ELSE 'unknown:0.2' END AS c FROM n)
SELECT name, split_part(c, ':', 1) AS category, CAST(split_part(c, ':', 2) AS DOUBLE) AS confidence FROM c""")
def classify_copybook(spark, sf_dir):
    c = classify.copybook_class(F.col("name"))
    return frame(spark, "fx_copybooks").select("name", c["label"].alias("category"), c["confidence"].alias("confidence"))


@query(f"""WITH {sql('fx_calls')}, c AS (SELECT call_type, target, CASE WHEN contains(upper(call_type), 'CICSXCTL') THEN 'control_transfer:0.9' WHEN contains(upper(call_type), 'CICSLINK') THEN 'sync_service_call:0.7'
 WHEN contains(upper(call_type), 'CALL') AND contains(upper(target), 'SEMA') THEN 'concurrency_or_locking:0.55' WHEN contains(upper(call_type), 'CALL') AND contains(upper(target), 'UTI') THEN 'utility_service:0.55'
 WHEN contains(upper(call_type), 'CALL') THEN 'subprogram_call:0.45' ELSE 'unknown:0.2' END AS c FROM fx_calls)
SELECT call_type, target, split_part(c, ':', 1) AS intent, CAST(split_part(c, ':', 2) AS DOUBLE) AS confidence FROM c""")
def classify_call(spark, sf_dir):
    c = classify.call_intent(F.col("call_type"), F.col("target"))
    return frame(spark, "fx_calls").select("call_type", "target", c["label"].alias("intent"), c["confidence"].alias("confidence"))


_RULES = f"""{sql('fx_edges')}, a AS (SELECT *, trim(regexp_replace(condition, '\\s+', ' ', 'g')) AS c,
 CASE WHEN contains(upper(dst), 'ABEND') THEN 'error' WHEN contains(upper(dst), 'XCTL') THEN 'permission' WHEN type IN ('CALL', 'CALL_RANGE') THEN 'precondition' WHEN upper(dst) IN ('RETURN', 'EXIT') THEN 'validation' ELSE 'control' END AS category
 FROM fx_edges WHERE condition <> ''),
b AS (SELECT *, CASE WHEN regexp_matches(upper(c), '{"|".join(fixed.SCREEN_TOKENS)}') THEN 'ui' WHEN regexp_matches(upper(c), '{"|".join(fixed.PAGING_TOKENS)}') THEN 'technical'
 WHEN regexp_matches(upper(c), '{"|".join(fixed.MODE_TOKENS)}') THEN CASE WHEN category = 'control' THEN 'business_logic' ELSE 'business' END
 WHEN contains(upper(c), 'TWCOB-FASE') THEN 'state' WHEN category <> 'control' THEN 'business' ELSE 'control' END AS kind FROM a)"""


@query(f"""WITH {_RULES} SELECT program, 'BR-' || lpad(CAST(row_number() OVER (PARTITION BY program ORDER BY edge_no) AS VARCHAR), 3, '0') AS id, src AS scope, category, kind,
 CASE category WHEN 'error' THEN 'fatal' WHEN 'permission' THEN 'block' WHEN 'precondition' THEN 'guard' WHEN 'validation' THEN 'reject' ELSE 'neutral' END AS severity, c AS condition, type || ' -> ' || dst AS action,
 CASE WHEN regexp_matches(c, '{fixed.INVERTED}') THEN '{fixed.INVERTED_FLAG}' ELSE '' END AS flags FROM b WHERE kind <> 'technical'""")
def rule_classification(spark, sf_dir):
    """Rules of conditioned edges: technical ones go before the rest are numbered."""
    return _joined(rules.rules(frame(spark, "fx_edges")).select("program", "id", "scope", "category", "kind", "severity", "condition", "action", "flags"), "flags")


@query()
def rule_documents(spark, sf_dir):
    """Rules' documents, with BLAKE2 ids."""
    r = rules.rules(frame(spark, "fx_edges"))
    return rules.detail_documents(r).unionByName(rules.business_documents(r)).select("id", "type", "program", "title", "embedding_text", "content", "meta")


@query(f"""WITH {sql('fx_edges')}, c AS (SELECT program, edge_no, condition AS c, list_transform(regexp_split_to_array(upper(regexp_replace(condition, '[()]', '', 'g')), '\\s+OR\\s+'), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))) AS t FROM fx_edges WHERE condition <> '')
SELECT program, edge_no, array_to_string(list_filter([CASE WHEN length(replace(c, '(', '')) <> length(replace(c, ')', '')) THEN 'unbalanced' END, CASE WHEN regexp_matches(c, '\\({{4,}}|\\){{4,}}') THEN 'many_parens' END,
 CASE WHEN regexp_matches(c, '(?i)\\b(AND|OR|NOT)\\s*\\)|\\(\\s*(AND|OR)\\b|\\(\\s*\\)|^\\s*(AND|OR)\\b|\\b(AND|OR|NOT)\\s*$') THEN 'malformed' END, CASE WHEN len(list_distinct(t)) < len(t) THEN 'duplicate_or_term' END], lambda x: x IS NOT NULL), ',') AS issues FROM c""")
def condition_lint(spark, sf_dir):
    rows = frame(spark, "fx_edges").where("condition <> ''")
    return rows.select("program", "edge_no", F.array_join(classify.condition_issues(F.col("condition")), ",").alias("issues"))


@query(f"""WITH {sql('fx_edges')}, x AS (SELECT *, coalesce(condition, '') <> '' AS has, length(replace(condition, '(', '')) <> length(replace(condition, ')', '')) AS ub, regexp_matches(condition, '\\({{4,}}|\\){{4,}}') AS mp,
 list_transform(regexp_split_to_array(upper(regexp_replace(condition, '[()]', '', 'g')), '\\s+OR\\s+'), lambda x: trim(x)) AS t FROM fx_edges)
SELECT count(*) AS n_edges, count(*) FILTER (has) AS n_conditions, round(count(*) FILTER (has AND ub) / count(*) FILTER (has), 6) AS unbalanced_rate, round(count(*) FILTER (has AND mp) / count(*) FILTER (has), 6) AS many_parens_rate,
 round(count(*) FILTER (has AND regexp_matches(condition, '(?i)\\b(AND|OR|NOT)\\s*\\)|\\(\\s*(AND|OR)\\b|\\(\\s*\\)|^\\s*(AND|OR)\\b|\\b(AND|OR|NOT)\\s*$')) / count(*) FILTER (has), 6) AS malformed_rate, round(count(*) FILTER (has AND len(list_distinct(t)) < len(t)) / count(*) FILTER (has), 6) AS duplicate_or_term_rate FROM x""")
def condition_quality(spark, sf_dir):
    """Rates of each issue over all conditions."""
    return graph.condition_quality(frame(spark, "fx_edges"))


@query()
def condition_simplify(spark, sf_dir):
    """Conditions parsed, simplified and printed again."""
    return frame(spark, "fx_conditions").select("id", simplified_udf("condition").alias("simplified"))


@query(f"""WITH {sql('fx_texts')} SELECT id, upper(trim(coalesce(text, ''), ' ' || chr(9) || chr(10))) AS upper_name, rtrim(rtrim(upper(trim(text, ' ' || chr(9) || chr(10))), '.'), ',') AS paragraph_name,
 trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) AS collapsed, CASE WHEN trim(regexp_replace(upper(coalesce(text, '')), '[^A-Z0-9-]+', '_', 'g'), '_') = '' THEN 'ITEM' ELSE trim(regexp_replace(upper(coalesce(text, '')), '[^A-Z0-9-]+', '_', 'g'), '_') END AS safe_name,
 regexp_replace(regexp_replace(text, '''[^'']*''', ' ', 'g'), '"[^"]*"', ' ', 'g') AS unquoted, trim(split_part(text, ',', 1), ' ' || chr(9) || chr(10)) AS before_comma, regexp_replace(text, '^[0-9]{{6}}', '') AS without_sequence,
 replace(replace(coalesce(text, ''), 'â†’', '->'), '→', '->') AS arrows FROM fx_texts""")
def text_functions(spark, sf_dir):
    t = F.col("text")
    return frame(spark, "fx_texts").select(
        "id", text.upper_name(t).alias("upper_name"), text.paragraph_name(t).alias("paragraph_name"), text.collapse(t).alias("collapsed"), text.safe_name(t).alias("safe_name"),
        text.unquoted(t).alias("unquoted"), text.before_comma(t).alias("before_comma"), text.without_sequence(t).alias("without_sequence"), text.ascii_arrows(t).alias("arrows"),
    )


@query()
def operand_functions(spark, sf_dir):
    """Quote- and bracket-aware splitting of job operands and notes, as regular expressions."""
    t = F.col("text")
    rows = frame(spark, "fx_texts").where("text IS NOT NULL")
    body, note = text.inline_note(t)
    cut, more = text.continuation_note(t)
    positional, keyword = text.operands(cut)
    return rows.select("id", body.alias("body"), note.alias("note"), cut.alias("cut"), more.alias("more"), F.array_join(positional, "|").alias("positional"), F.to_json(keyword).alias("keyword"))


# --- graphs ------------------------------------------------------------------------------------------


@query(f"WITH {sql('fx_order')}, {sql('fx_ranges')} SELECT r.file, r.range_start, r.range_end, a.paragraph AS src, b.paragraph AS dst FROM fx_ranges r JOIN fx_order s ON s.file = r.file AND s.paragraph = r.range_start JOIN fx_order e ON e.file = r.file AND e.paragraph = r.range_end JOIN fx_order a ON a.file = r.file AND a.ord >= s.ord JOIN fx_order b ON b.file = r.file AND b.ord = a.ord + 1 AND b.ord <= e.ord WHERE s.ord <= e.ord")
def successive_in_ranges(spark, sf_dir):
    order = frame(spark, "fx_order")
    pairs = order.alias("a").join(order.alias("b"), (F.col("a.file") == F.col("b.file")) & (F.col("b.ord") == F.col("a.ord") + 1)).select("a.file", F.col("a.paragraph").alias("src"), F.col("b.paragraph").alias("dst"))
    return relational.successive_in_ranges(pairs, order, frame(spark, "fx_ranges")).select("file", "range_start", "range_end", "src", "dst")


@query(f"WITH {sql('fx_order')} SELECT file, paragraph, ord FROM fx_order o WHERE ord BETWEEN (SELECT ord FROM fx_order x WHERE x.file = o.file AND paragraph = 'B') AND (SELECT ord FROM fx_order x WHERE x.file = o.file AND paragraph = 'D')")
def slice_between(spark, sf_dir):
    return relational.slice_between(frame(spark, "fx_order"), "B", "D").select("file", "paragraph", "ord")


@query(f"""WITH {sql('fx_edges')} SELECT program, src AS context, condition AS trigger, CASE WHEN contains(condition, 'EIBAID') AND contains(condition, 'NOT') THEN 'OTHER' ELSE coalesce(nullif(regexp_extract(condition, 'EIBAID\\s*=\\s*([A-Z0-9-]+)', 1), ''), 'UNKNOWN') END AS key,
 CASE WHEN contains(condition, 'EIBAID') AND contains(condition, 'NOT') THEN array_to_string(list_sort(list_distinct(regexp_extract_all(condition, 'DFH[A-Z0-9]+'))), ',') ELSE '' END AS other_keys, dst AS target, type AS edge_type FROM fx_edges WHERE contains(condition, 'EIBAID') OR contains(condition, 'DFH')""")
def ui_actions(spark, sf_dir):
    return _joined(graph.screen_actions(frame(spark, "fx_edges")).drop("evidence"), "other_keys")


@query(f"""WITH {sql('fx_dot')}, e AS (SELECT file, unnest(generate_series(1, len(s))) AS edge_no, unnest(s) AS src, unnest(d) AS dst FROM (SELECT file, regexp_extract_all(text, '<([^>]+)>\\s*->\\s*<([^>]+)>\\s*;', 1) AS s, regexp_extract_all(text, '<([^>]+)>\\s*->\\s*<([^>]+)>\\s*;', 2) AS d FROM fx_dot))
SELECT file, CAST(edge_no AS INTEGER) AS edge_no, src, dst FROM e""")
def dot_edges(spark, sf_dir):
    return documents.dot_edges(frame(spark, "fx_dot"))


@query(f"""WITH {sql('fx_dot')} SELECT file, nullif(regexp_extract(text, '(?i)digraph\\s+([A-Za-z0-9_-]+)\\s*\\{{', 1), '') AS name, coalesce(nullif(regexp_extract(text, '(?i)rankdir\\s*=\\s*([A-Z]{{2}})', 1), ''), 'LR') AS rankdir,
 CASE WHEN NOT regexp_matches(text, '(?i)digraph\\s+([A-Za-z0-9_-]+)\\s*\\{{') THEN 'missing_digraph' WHEN NOT regexp_matches(text, '<[^>]+>\\s*->\\s*<[^>]+>\\s*;') THEN 'no_edges' END AS problem FROM fx_dot""")
def dot_graphs(spark, sf_dir):
    return documents.dot_graphs(frame(spark, "fx_dot"))


_FIXED = f"""{sql('fx_cobol')}, c AS (SELECT file, line_no, substr(rpad(raw, 80, ' '), 7, 1) AS ind, rtrim(substr(rpad(raw, 80, ' '), 8, 65)) AS code FROM fx_cobol),
k AS (SELECT *, sum(CASE WHEN ind = '-' THEN 0 ELSE 1 END) OVER (PARTITION BY file ORDER BY line_no) AS part FROM c WHERE ind NOT IN ('*', '/') AND code <> ''),
s AS (SELECT file, min(line_no) AS line_start, max(line_no) AS line_end, trim(string_agg(trim(code), ' ' ORDER BY line_no)) AS statement FROM k GROUP BY file, part)"""


@query(f"WITH {_FIXED} SELECT * FROM s")
def fixed_format_statements(spark, sf_dir):
    """Fixed columns, and continuations joined by a running count."""
    return cobol.statements(frame(spark, "fx_cobol"))


_WORDS = ", ".join(f"'{w}'" for w in sorted(fixed.DATAFLOW_WORDS))
_PROC = f"""{_FIXED}, d AS (SELECT *, nullif(regexp_extract(upper(statement), '^\\s*(IDENTIFICATION|ENVIRONMENT|DATA|PROCEDURE)\\s+DIVISION\\b', 1), '') AS h FROM s),
p AS (SELECT *, last_value(h IGNORE NULLS) OVER (PARTITION BY file ORDER BY line_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS division FROM d),
q AS (SELECT file, line_start, statement, nullif(regexp_extract(upper(statement), '^\\s*([A-Z][A-Z0-9-]{{1,30}})\\.\\s*$', 1), '') AS name FROM p WHERE division = 'PROCEDURE' AND h IS NULL),
r AS (SELECT *, coalesce(last_value(CASE WHEN name NOT IN ({_WORDS}) THEN name END IGNORE NULLS) OVER (PARTITION BY file ORDER BY line_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'TOP') AS paragraph FROM q)"""


@query(f"WITH {_PROC} SELECT file, line_start, paragraph, statement FROM r WHERE name IS NULL")
def paragraph_statements(spark, sf_dir):
    """Statements of the procedure with their paragraph filled forward."""
    rows = cobol.with_paragraphs(cobol.procedure_statements(cobol.statements(frame(spark, "fx_cobol"))), F.lit("TOP"))
    return rows.select("file", "line_start", "paragraph", "statement")


@query(f"""WITH {_PROC} SELECT line_start, x.dst AS target, x.range_end FROM (SELECT line_start, CASE WHEN regexp_matches(upper(statement), '\\bPERFORM\\b\\s+([A-Z0-9-]+)\\s+(THRU|THROUGH)') THEN regexp_extract(upper(statement), '\\bPERFORM\\b\\s+([A-Z0-9-]+)', 1)
 ELSE nullif(regexp_extract(upper(statement), '\\bPERFORM\\b\\s+([A-Z0-9-]+)', 1), '') END AS dst, nullif(regexp_extract(upper(statement), '\\bPERFORM\\b\\s+([A-Z0-9-]+)\\s+(?:THRU|THROUGH)\\s+([A-Z0-9-]+)', 2), '') AS range_end FROM r
 UNION ALL SELECT line_start, unnest(regexp_extract_all(regexp_extract(upper(statement), '\\bGO\\s+TO\\b\\s+([^.]+)', 1), '[A-Z][A-Z0-9-]*')), NULL FROM r) x WHERE x.dst IS NOT NULL AND x.dst NOT IN ('UNTIL', 'VARYING', 'TEST')""")
def perform_goto_extract(spark, sf_dir):
    """Targets of performs, ranges and jumps."""
    rows = cobol.procedure_statements(cobol.statements(frame(spark, "fx_cobol")))
    target, end = graph.performed(F.col("statement"))
    performs = rows.select("line_start", target.alias("target"), end.alias("range_end")).where("target IS NOT NULL")
    return performs.union(rows.select("line_start", F.explode(graph.gone_to(F.col("statement"))).alias("target"), F.lit(None).cast("string")))


@query()
def control_flow_edges(spark, sf_dir):
    """The graph of program text in order of discovery."""
    return graph.extract(frame(spark, "fx_cobol"))[1]


@query()
def control_flow_nodes(spark, sf_dir):
    return graph.extract(frame(spark, "fx_cobol"))[0]


@functools.lru_cache(maxsize=2)
def _program(spark):
    return program.program_relations(frame(spark, "fx_cobol"))


@query()
def enriched_edges(spark, sf_dir):
    """Edges with type, condition, ranges, verbs and evidence."""
    rows = _program(spark)["edges"].withColumn("range_flow_of", F.to_json("range_flow_of"))
    return _joined(rows.withColumn("cics_ops", F.coalesce("cics_ops", F.array().cast("array<string>"))), "cics_ops")


@query(f"""WITH {sql('fx_cobol')}, l AS (SELECT line_no, rtrim(raw) AS raw, line_no > (SELECT min(line_no) FROM fx_cobol WHERE regexp_matches(upper(raw), '^\\s*PROCEDURE\\s+DIVISION\\.\\s*$')) AS body FROM fx_cobol WHERE NOT starts_with(trim(raw), '*')),
m AS (SELECT *, nullif(upper(regexp_extract(raw, '(?i)^\\s*([A-Z0-9-]+)\\s*\\.\\s*$', 1)), '') AS label FROM l WHERE body),
p AS (SELECT line_no, raw, label, coalesce(last_value(label IGNORE NULLS) OVER (ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'BILLRUN') AS paragraph FROM m)
SELECT line_no, paragraph, raw FROM p WHERE label IS NULL""")
def raw_paragraphs(spark, sf_dir):
    """Paragraphs as the edge reader sees them: any lone word with a full stop opens one."""
    lines = frame(spark, "fx_cobol")
    return cobol.raw_paragraph_lines(lines, program_names(lines)).select("line_no", "paragraph", "raw")


@query(f"WITH {sql('fx_edges')}, e AS (SELECT *, CASE WHEN type = 'JUMP' THEN 'GO TO ' || dst ELSE 'PERFORM ' || dst || ' THRU ' || dst || '-EXIT' END AS line FROM fx_edges) SELECT program, edge_no, CASE WHEN type = 'JUMP' THEN 'JUMP' ELSE 'CALL_RANGE' END AS type, line AS evidence FROM e")
def edge_typing_first_match(spark, sf_dir):
    """The first line that reaches the target types the edge; a later perform of the same target doesn't."""
    edges = frame(spark, "fx_edges")
    line = F.when(F.col("type") == "JUMP", F.concat(F.lit("GO TO "), "dst")).otherwise(F.concat(F.lit("PERFORM "), "dst", F.lit(" THRU "), "dst", F.lit("-EXIT")))
    lines = edges.select("program", F.col("src").alias("paragraph"), F.col("edge_no").alias("line_no"), line.alias("raw"))
    late = edges.select("program", F.col("src").alias("paragraph"), (F.col("edge_no") + 100).alias("line_no"), F.concat(F.lit("PERFORM "), "dst").alias("raw"))
    return graph.typed(edges.select("program", "edge_no", "src", "dst"), lines.union(late)).select("program", "edge_no", "type", "evidence")


@query()
def jump_conditions(spark, sf_dir):
    """Under which condition each jump of a paragraph is taken."""
    lines = frame(spark, "fx_cobol")
    return graph.jump_conditions(cobol.raw_paragraph_lines(lines, program_names(lines)))


@query()
def screen_maps(spark, sf_dir):
    lines = frame(spark, "fx_cobol")
    return _joined(graph.screen_maps(lines, program_names(lines)), "operations", "options", "evidence")


# --- data flow ---------------------------------------------------------------------------------------


@query()
def var_read_write(spark, sf_dir):
    """Sites of variables: written, read, deciding."""
    return _joined(_program(spark)["sites"], "targets")


@query()
def variable_records(spark, sf_dir):
    r = _program(spark)
    rows = dataflow.variable_records(r["variables"], r["sites"]).select("program", "variable", "origin", "defined_in", "modified_in", "used_in", "fanout_nodes", "controls_flow")
    return _joined(rows, "defined_in", "modified_in", "used_in", "fanout_nodes")


@query(f"""WITH {_FIXED}, u AS (SELECT file, line_start, upper(statement) AS u FROM s),
m AS (SELECT file, line_start, nullif(regexp_extract(u, '^\\s*(IDENTIFICATION|ENVIRONMENT|DATA|PROCEDURE)\\s+DIVISION\\b', 1), '') AS d, nullif(regexp_extract(u, '^\\s*([A-Z0-9-]+)\\s+SECTION\\.\\s*$', 1), '') AS s, regexp_extract(u, '^\\s*([0-9]{{2}})\\s+([A-Z][A-Z0-9-]+)\\b', 1) AS lv, regexp_extract(u, '^\\s*([0-9]{{2}})\\s+([A-Z][A-Z0-9-]+)\\b', 2) AS v FROM u),
f AS (SELECT *, last_value(d IGNORE NULLS) OVER w AS division, last_value(s IGNORE NULLS) OVER w AS section, last_value(CASE WHEN lv = '01' THEN v END IGNORE NULLS) OVER w AS rec FROM m WINDOW w AS (PARTITION BY file ORDER BY line_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT file, v AS variable, CASE WHEN starts_with(v, 'DFH') THEN 'CICS_CONST' WHEN section = 'LINKAGE' AND rec IN ('DFHCOMMAREA', 'COMMAREA', 'LK-COMMAREA') THEN 'COMMAREA' ELSE section END AS origin FROM f WHERE division = 'DATA' AND v <> ''""")
def declarations(spark, sf_dir):
    """Declared fields with their origin."""
    return cobol.declarations(cobol.statements(frame(spark, "fx_cobol")))


@query()
def used_variables(spark, sf_dir):
    r = _program(spark)
    return dataflow.used(r["variables"], r["sites"])


@query()
def literal_assignments(spark, sf_dir):
    r = _program(spark)
    control = dataflow.variable_records(r["variables"], r["sites"]).select("program", "variable", "controls_flow")
    return dataflow.literal_assignments(r["sites"], r["variables"], control)


@query()
def outgoing_calls(spark, sf_dir):
    return _joined(_program(spark)["calls"].drop("file"), "parameters")


@query()
def call_parameters(spark, sf_dir):
    """What is written before and read after a call, for each field of its parameters."""
    r = _program(spark)
    calls = r["calls"].withColumn("call_id", short_blake(F.concat_ws("|", "program", "target", F.col("line_start").cast("string"), "statement")))
    return dataflow.call_parameters(calls, r["sites"])


@query()
def screen_lineage(spark, sf_dir):
    r = _program(spark)
    vars_ = r["variables"].withColumn("origin", F.when(F.startswith("variable", F.lit("CUST-")), "COPY:PDCUST01").otherwise(F.col("origin")))
    screens = r["programs"].select("program", F.lit("PDCUST01").alias("name"))
    return _joined(dataflow.screen_lineage(vars_, r["sites"], screens), "members")


@query()
def first_site_lines(spark, sf_dir):
    return dataflow.first_site_line(_program(spark)["sites"])


@query()
def unused_copybooks(spark, sf_dir):
    r = _program(spark)
    books = facts.copybooks(facts.records(frame(spark, "fx_facts"))).select("program", "name")
    vars_ = r["variables"].withColumn("origin", F.when(F.startswith("variable", F.lit("CUST-")), "COPY:PDCUST01").otherwise(F.col("origin")))
    return dataflow.unused_copybooks(books, dataflow.copybook_evidence(books, vars_, r["sites"]))


@query(f"""WITH {sql('fx_cobol')} SELECT DISTINCT file, upper(regexp_extract(raw, '(?i)^\\s*(?:[A-Z0-9-]+\\s+)?COPY\\s+[''"]?([A-Z0-9_-]+)', 1)) AS copybook FROM fx_cobol WHERE regexp_matches(raw, '(?i)^\\s*(?:[A-Z0-9-]+\\s+)?COPY\\s+[''"]?([A-Z0-9_-]+)')""")
def copy_references(spark, sf_dir):
    return cobol.copy_references(frame(spark, "fx_cobol"))


# --- comments ----------------------------------------------------------------------------------------


@query()
def program_comments(spark, sf_dir):
    rows = _program(spark)["comments"]
    ident = comment_id(F.col("program"), F.col("line_no"), F.col("kind"), F.col("text"))
    return rows.select(ident.alias("id"), "line_no", "section", "paragraph", "kind", "text", "classification", "indexable")


@query()
def comment_metrics(spark, sf_dir):
    lines = frame(spark, "fx_cobol")
    return comment_ops.metrics(lines, comment_ops.classified(cobol.comments(lines)))


@query()
def comment_documents(spark, sf_dir):
    r = _program(spark)
    return comment_ops.comment_documents(r["comments"], comment_ops.links(r["rules"], r["sites"])).select("id", "type", "title", "embedding_text", "meta")


# --- records -----------------------------------------------------------------------------------------


def _records(spark):
    return facts.records(frame(spark, "fx_facts"))


_FACTS = f"""{sql('fx_facts')}, f AS (SELECT line_no, trim(raw) AS line, list_transform(regexp_extract_all(trim(raw) || ',', ' *("(?:[^"]|"")*"[^,]*|[^,]*),', 1), lambda x: trim(x, '"')) AS p FROM fx_facts WHERE trim(raw) <> ''),
g AS (SELECT *, upper(trim(p[1])) AS rec, CASE WHEN upper(trim(p[1])) = 'FILE' THEN upper(regexp_replace(regexp_extract(p[3], '([^/\\\\]*)$', 1), '\\.[^.]*$', '')) END AS named FROM f),
r AS (SELECT line_no, line, p, rec, coalesce(last_value(named IGNORE NULLS) OVER (ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'UNKNOWN') AS program FROM g)"""


@query(f"WITH {_FACTS} SELECT line_no, program, rec, array_to_string(p, '|') AS parts FROM r")
def fact_records(spark, sf_dir):
    """Comma-separated records of many types with their program filled forward."""
    return _records(spark).select("line_no", "program", "rec", F.array_join("parts", "|").alias("parts"))


@query(f"WITH {_FACTS} SELECT program, upper(p[len(p)]) AS name, min(line_no) AS line_no FROM r WHERE rec = 'COPY' GROUP BY ALL")
def fact_copybooks(spark, sf_dir):
    return facts.copybooks(_records(spark))


@query(f"WITH {_FACTS} SELECT program, upper(p[len(p)-1]) AS call_type, upper(p[len(p)]) AS target, min(line_no) AS line_no FROM r WHERE rec = 'CALL' AND len(p) >= 6 GROUP BY ALL")
def fact_calls(spark, sf_dir):
    return facts.calls(_records(spark))


@query(f"WITH {_FACTS} SELECT program, upper(p[4]) AS table_name, p[5] AS stmt_type, min(line_no) AS line_no FROM r WHERE rec = 'DB2TABLE' GROUP BY ALL")
def fact_tables(spark, sf_dir):
    return facts.tables(_records(spark)).withColumnRenamed("table", "table_name")


@query(f"""WITH {_FACTS} SELECT program, max_by(p[3], line_no) FILTER (rec = 'FILE') AS file_path, CAST(max_by(try_cast(p[5] AS INTEGER), line_no) FILTER (rec = 'PGM') AS INTEGER) AS loc, CAST(arg_max_null(try_cast(p[6] AS INTEGER), line_no) FILTER (rec = 'PGM') AS INTEGER) AS statements FROM r GROUP BY program""")
def fact_metrics(spark, sf_dir):
    return facts.metrics(_records(spark)).select("program", "file_path", "loc", "statements")


@query(f"WITH {_FACTS} SELECT program, rec, count(*) AS n, string_agg(line, '|' ORDER BY line_no) AS examples FROM r WHERE rec NOT IN ('FILE', 'COPY', 'SQLINCLUDE', 'PGM', 'CALL', 'UNRESOLVEDCALL', 'DB2TABLE') AND NOT starts_with(rec, 'CICS') GROUP BY ALL")
def fact_unhandled(spark, sf_dir):
    return facts.unhandled(_records(spark)).withColumn("examples", F.array_join("examples", "|"))


@query()
def fact_documents(spark, sf_dir):
    """All documents of records, with built-in ids."""
    return _joined(document_ops.fact_documents(_records(spark)), "evidence")


@query()
def global_map_documents(spark, sf_dir):
    """Documents of the maps across programs."""
    return program.corpus_documents(_records(spark), _program(spark)).select("id", "type", "title", "embedding_text", "content")


@query(f"""WITH {_FACTS}, c AS (SELECT DISTINCT upper(p[len(p)]) AS copybook, program FROM r WHERE rec = 'COPY') SELECT copybook, count(*) AS program_count, string_agg(program, ',' ORDER BY program) AS programs FROM c GROUP BY copybook""")
def copybook_map(spark, sf_dir):
    return _joined(maps.copybook_map(facts.copybooks(_records(spark))).select("copybook", "program_count", "programs"), "programs")


@query()
def index_records(spark, sf_dir):
    """Documents flattened, cut and identified."""
    rows = program.index_records(document_ops.fact_documents(_records(spark)).unionByName(rules.detail_documents(rules.rules(frame(spark, "fx_edges")))))
    return rows.select("id", "program", "type", "title", "text", F.to_json("metadata").alias("metadata"))


@query()
def index_manifest(spark, sf_dir):
    return index_ops.manifest(program.index_records(document_ops.fact_documents(_records(spark))))


@query()
def code_chunks(spark, sf_dir):
    """Program lines cut at divisions, sections and paragraphs."""
    lines = frame(spark, "fx_cobol")
    return index_ops.code_documents(index_ops.code_chunks(lines, 30, 5), program_names(lines))


# --- jobs --------------------------------------------------------------------------------------------


@functools.lru_cache(maxsize=2)
def _jobs(spark):
    return program.job_relations(frame(spark, "fx_jcl"))


@query()
def jcl_statements(spark, sf_dir):
    return _joined(jcl.job_statements(frame(spark, "fx_jcl")), "notes")


@query(f"""WITH {sql('fx_jcl')}, c AS (SELECT file, line_no, trim(regexp_replace(trim(regexp_replace(regexp_replace(trim(substr(raw, 4)), '^/+', ''), '\\|+$', '')), '\\s+', ' ', 'g')) AS text FROM fx_jcl WHERE starts_with(raw, '//*'))
SELECT file, line_no, text, regexp_replace(text, '[\\s*/|#=_.:-]+', '', 'g') = '' AS decorative, regexp_matches(upper(text), '{"|".join(fixed.WARNING_WORDS)}') AS warning FROM c""")
def jcl_comments(spark, sf_dir):
    return jcl.job_comments(frame(spark, "fx_jcl"))


@query()
def jcl_steps(spark, sf_dir):
    rows = jcl.steps(jcl.job_statements(frame(spark, "fx_jcl"))).withColumn("parameters", F.to_json("parameters"))
    return _joined(rows, "notes")


@query()
def jcl_access(spark, sf_dir):
    """Data definitions with access and why."""
    return _jobs(spark)["definitions"].select("file", "step", "dd_ordinal", "ddname", "concatenated", "dsn", "access_type", "access_reason", "dataset_kind", "is_temporary")


@query()
def jcl_execution(spark, sf_dir):
    return _jobs(spark)["executed"]


@query()
def jcl_catalog(spark, sf_dir):
    return _joined(_jobs(spark)["catalog"], "produced_by", "consumed_by", "controlled_by", "deleted_by")


@query()
def jcl_lineage(spark, sf_dir):
    """Which step's dataset another reads or deletes."""
    return _jobs(spark)["flow"]


@query()
def jcl_step_datasets(spark, sf_dir):
    return _joined(_jobs(spark)["step_datasets"], "reads", "writes", "deletes", "controls", "unknowns", "sysouts")


@query()
def jcl_notes(spark, sf_dir):
    """Comments before steps, sections, purpose, highlights and warnings."""
    a = _jobs(spark)
    at = lambda df, what, k, v: df.select("file", F.lit(what).alias("what"), k.cast("string").alias("at"), v.alias("text"))
    out = at(a["step_comments"], "context", F.col("seq"), F.array_join("comment_context", "|")).union(at(a["sections"], "section", F.concat_ws("-", "section", "item_no"), F.col("item")))
    out = out.union(at(a["purpose"], "purpose", F.lit(""), F.col("purpose"))).union(at(a["warnings"], "warnings", F.lit(""), F.array_join("warnings", "|")))
    return out.union(at(a["highlights"], "highlights", F.lit(""), F.array_join("highlights", "|")))


@query()
def jcl_symbols(spark, sf_dir):
    return _jobs(spark)["symbols"]


@query()
def jcl_validation(spark, sf_dir):
    return _joined(jobs.validation(_jobs(spark)), "programs", "flags")


@query()
def jcl_validation_summary(spark, sf_dir):
    return jobs.validation_summary(jobs.validation(_jobs(spark)))


@query()
def jcl_procedures(spark, sf_dir):
    return _joined(jobs.procedure_catalog(_jobs(spark)), "programs")


@query()
def jcl_file_use(spark, sf_dir):
    rows = jobs.file_use(_jobs(spark), "IEFBR14").select("file", "job", "step", "program", "reads", "writes", "deletes")
    return _joined(rows, "reads", "writes", "deletes")


@query()
def jcl_documents(spark, sf_dir):
    return jobs.job_documents(_jobs(spark))


# --- packages and checks -----------------------------------------------------------------------------


_STATUS = f"""{sql('fx_programs')}, {sql('fx_outputs')}, j AS (SELECT coalesce(p.program, o.program) AS program, p.program IS NOT NULL AS hp, o.program IS NOT NULL AS ho, * EXCLUDE (program) FROM fx_programs p FULL JOIN fx_outputs o ON p.program = o.program),
c AS (SELECT program, list_filter([CASE WHEN hp AND cobol_count = 0 THEN 'F:missing COBOL source' END, CASE WHEN hp AND cobol_count > 1 THEN 'W:' || cobol_count || ' COBOL sources in package' END, CASE WHEN hp AND manifest_valid = FALSE THEN 'W:invalid package manifest' END,
 CASE WHEN hp AND NOT has_mapa THEN 'F:missing MAPA' END, CASE WHEN hp AND NOT has_controlflow THEN 'F:missing controlflow' END, CASE WHEN hp AND copybook_count > 0 AND missing_copybooks > 0 THEN 'W:missing ' || missing_copybooks || ' copybooks' END, CASE WHEN hp AND copybook_count = 0 THEN 'W:no copybooks packaged' END,
 CASE WHEN NOT hp THEN 'W:no input package' END, CASE WHEN NOT ho THEN 'F:no pipeline output' END, CASE WHEN ho AND invalid_json > 0 THEN 'F:' || invalid_json || ' invalid JSON files' END,
 CASE WHEN ho AND n_missing > 0 THEN 'W:missing artifacts: ' || array_to_string(list_transform(generate_series(1, least(5, n_missing)), lambda i: 'a' || i), ', ') || CASE WHEN n_missing > 5 THEN ', +' || (n_missing - 5) || ' more' ELSE '' END END], lambda x: x IS NOT NULL) AS n FROM j),
t AS (SELECT program, CASE WHEN len(list_filter(n, lambda x: starts_with(x, 'F'))) > 0 THEN 'FAIL' WHEN len(n) > 0 THEN 'WARN' ELSE 'OK' END AS status, CASE WHEN len(n) = 0 THEN 'ready' ELSE array_to_string(list_transform(n, lambda x: substr(x, 3)), '|') END AS notes FROM c)"""


@query(f"WITH {_STATUS} SELECT * FROM t")
def program_status(spark, sf_dir):
    """What packages and outputs lack, program by program."""
    return _status(spark).withColumn("notes", F.array_join("notes", "|"))


def _status(spark):
    outputs = frame(spark, "fx_outputs")
    lacks = F.when(F.col("n_missing") > 0, F.transform(F.sequence(F.lit(1), "n_missing"), lambda i: F.concat(F.lit("a"), i.cast("string")))).otherwise(F.array().cast("array<string>"))
    return quality.program_status(frame(spark, "fx_programs"), outputs.select("program", "invalid_json", lacks.alias("missing_artifacts")))


@query(f"WITH {_STATUS} SELECT count(*) AS program_count, count(*) FILTER (status = 'OK') AS ok, count(*) FILTER (status = 'WARN') AS warn, count(*) FILTER (status = 'FAIL') AS fail FROM t")
def status_summary(spark, sf_dir):
    return quality.status_summary(_status(spark))


_REASONS = f"{_STATUS}, u AS (SELECT program, unnest(string_split(notes, '|')) AS note FROM t), g AS (SELECT note, count(*) AS n, min(program) AS first FROM u WHERE note <> 'ready' GROUP BY note ORDER BY n DESC, first, note LIMIT 20)"


@query(f"WITH {_REASONS} SELECT note, n FROM g")
def top_reasons(spark, sf_dir):
    return quality.top_reasons(_status(spark), 20)


@query()
def package_manifest(spark, sf_dir):
    """What each program's package holds and lacks."""
    lines = frame(spark, "fx_cobol")
    file = lambda *names: spark.createDataFrame([(n,) for n in names], "file string")
    scripts = frame(spark, "fx_jcl").groupBy("file").agg(F.array_join(F.collect_list("raw"), "\n").alias("text"))
    rows = quality.packages(program_names(lines), cobol.copy_references(lines), file("cpy/PDRUTI01.cpy"), file("facts/result.txt"), file("cfg/billrun.json", "cfg/other.json"), scripts)
    return _joined(rows, "copybooks", "missing_copybooks", "jobs")


@query()
def located_sources(spark, sf_dir):
    names = spark.createDataFrame([("BILLRUN",), ("twice",), ("none",)], "name string")
    return quality.located(names, spark.createDataFrame([("a/billrun.cbl",), ("a/TWICE.cbl",), ("b/twice.cbl",)], "file string"))


# --- relational cores, with their SQL ----------------------------------------------------------------


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


@query(f"""WITH {sql('fx_dds')}, d AS (SELECT *, upper(replace(coalesce(disp, ''), ' ', '')) AS n, trim(split_part(regexp_replace(upper(trim(coalesce(disp, ''))), '^\\((.*)\\)$', '\\1'), ',', 1)) AS st, coalesce(dsn, '') <> '' AS has FROM fx_dds)
SELECT id, CASE WHEN coalesce(sysout, '') <> '' THEN 'sysout' WHEN contains(upper(raw), 'DUMMY') AND NOT has THEN 'control' WHEN ddname IN ({_in(fixed.CONTROL_DD)}) THEN 'control' WHEN program = 'IEFBR14' AND contains(n, 'DELETE') THEN 'delete'
 WHEN ddname IN ({_in(fixed.READ_DD)}) THEN 'read' WHEN ddname IN ({_in(fixed.WRITE_DD)}) THEN 'write' WHEN st IN ('OLD', 'SHR') THEN 'read' WHEN st IN ('NEW', 'MOD') THEN 'write'
 WHEN starts_with(n, '(,') OR contains(n, '(,CATLG') OR contains(n, '(,PASS') THEN 'write' WHEN has THEN 'unknown' ELSE 'control' END AS access_type,
 CASE WHEN NOT has THEN NULL WHEN starts_with(upper(dsn), '&&') THEN 'temporary' WHEN starts_with(upper(dsn), 'SYS1.') OR starts_with(upper(dsn), 'SYSOUT') THEN 'system' ELSE 'persistent' END AS dataset_kind FROM d""")
def dataset_access(spark, sf_dir):
    """How a data definition uses its dataset: eleven rules, the first that holds."""
    a = classify.dataset_access(*[F.col(c) for c in ("ddname", "disp", "sysout", "raw", "dsn", "program")])
    return frame(spark, "fx_dds").select("id", a["access_type"].alias("access_type"), classify.dataset_kind(F.col("dsn")).alias("dataset_kind"))


@query(f"""WITH {sql('fx_usage')}, w AS (SELECT *, min(execution_order) FILTER (access_type = 'write') OVER (PARTITION BY file, dsn) AS fw FROM fx_usage)
SELECT file, job, dsn, (list(dataset_kind ORDER BY execution_order, dd_ordinal) FILTER (dataset_kind IS NOT NULL))[1] AS dataset_kind, bool_or(access_type IN ('read', 'control') AND (fw IS NULL OR execution_order < fw)) AS external_input, coalesce(string_agg(step, ',' ORDER BY execution_order, dd_ordinal) FILTER (access_type = 'write'), '') AS produced_by,
 coalesce(string_agg(step, ',' ORDER BY execution_order, dd_ordinal) FILTER (access_type = 'read'), '') AS consumed_by, coalesce(string_agg(step, ',' ORDER BY execution_order, dd_ordinal) FILTER (access_type = 'delete'), '') AS deleted_by, count(*) AS n_usages, min(fw) AS first_write_order FROM w GROUP BY file, job, dsn""")
def dataset_catalog(spark, sf_dir):
    return _joined(jobs.dataset_catalog(frame(spark, "fx_usage")).drop("controlled_by"), "produced_by", "consumed_by", "deleted_by")


@query(f"""WITH {sql('fx_usage')}, w AS (SELECT *, last_value(CASE WHEN access_type = 'write' THEN step END IGNORE NULLS) OVER (PARTITION BY file, dsn ORDER BY execution_order, dd_ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS from_step FROM fx_usage)
SELECT DISTINCT file, job, from_step, step AS to_step, dsn, CASE access_type WHEN 'read' THEN 'produces_input_for' ELSE 'deleted_after' END AS flow_type FROM w WHERE access_type IN ('read', 'delete') AND from_step IS NOT NULL""")
def dataset_flow(spark, sf_dir):
    """As-of join to the last write, as a window."""
    return jobs.dataset_flow(frame(spark, "fx_usage"))


@query(f"""WITH {sql('fx_steps')}, x AS (SELECT o.file, o.seq AS outer_seq, coalesce(i.seq, o.seq) AS seq, coalesce(i.step, o.step) AS step, CASE WHEN i.seq IS NULL THEN NULL ELSE o.step END AS invoked_by_step FROM fx_steps o LEFT JOIN fx_steps i ON o.exec_kind = 'procedure' AND o.resolved_locally AND i.file = o.file AND i.defined_in_proc = o.proc WHERE o.scope = 'job')
SELECT file, CAST(row_number() OVER (PARTITION BY file ORDER BY outer_seq, seq) AS INTEGER) AS execution_order, step, invoked_by_step FROM x""")
def execution_order(spark, sf_dir):
    """Steps in the order they run, local procedures expanded."""
    return jobs.execution_steps(frame(spark, "fx_steps")).select("file", "execution_order", "step", "invoked_by_step")


def _sites(spark):
    return frame(spark, "fx_sites").withColumn("targets", F.filter(F.split("targets", ","), lambda x: x != ""))


@query(f"""WITH {sql('fx_vars')}, {sql('fx_sites')} SELECT v.program, v.variable, v.origin, coalesce(arg_min(paragraph, line) FILTER (kind = 'write'), '') AS defined_in, coalesce(string_agg(DISTINCT paragraph, ',' ORDER BY paragraph) FILTER (kind = 'write'), '') AS modified_in,
 coalesce(string_agg(DISTINCT paragraph, ',' ORDER BY paragraph) FILTER (kind = 'read'), '') AS used_in, coalesce(bool_or(kind = 'control'), FALSE) AS controls_flow, coalesce(max(targets) FILTER (kind = 'control'), '') AS fanout_nodes FROM fx_vars v LEFT JOIN fx_sites s ON v.program = s.program AND v.variable = s.variable GROUP BY ALL""")
def variable_assembly(spark, sf_dir):
    """Variables' records from the long table of sites."""
    rows = dataflow.variable_records(frame(spark, "fx_vars"), _sites(spark)).select("program", "variable", "origin", "defined_in", "modified_in", "used_in", "controls_flow", "fanout_nodes")
    return _joined(rows, "defined_in", "modified_in", "used_in", "fanout_nodes")


@query(f"WITH {sql('fx_vars')}, {sql('fx_sites')} SELECT v.* FROM fx_vars v WHERE EXISTS (SELECT 1 FROM fx_sites s WHERE s.program = v.program AND s.variable = v.variable)")
def used_semi_join(spark, sf_dir):
    return dataflow.used(frame(spark, "fx_vars"), _sites(spark))


_MOVED = """(?i)\\bMOVE\\s+(''[^'']*''|"[^"]*"|[+-]?[0-9]+(?:\\.[0-9]+)?)\\s+TO\\s+([A-Z0-9-]+)\\b"""


@query(f"""WITH {sql('fx_vars')}, {sql('fx_sites')} SELECT DISTINCT s.program, s.variable AS target_variable, regexp_extract(statement, '{_MOVED}', 1) AS literal_raw, trim(regexp_extract(statement, '{_MOVED}', 1), chr(39) || chr(34)) AS literal, paragraph, line,
 starts_with(v.origin, 'COPY:PDCBVCM') AS screen_or_map_field, starts_with(s.variable, 'PD1FS00-') AS call_commarea_field FROM fx_sites s JOIN fx_vars v ON s.program = v.program AND s.variable = v.variable WHERE kind = 'write' AND upper(regexp_extract(statement, '{_MOVED}', 2)) = s.variable AND regexp_matches(statement, '{_MOVED}')""")
def moved_literals(spark, sf_dir):
    sites, vars_ = _sites(spark), frame(spark, "fx_vars")
    control = vars_.select("program", "variable", F.lit(False).alias("controls_flow"))
    return dataflow.literal_assignments(sites, vars_, control).select("program", "target_variable", "literal_raw", "literal", "paragraph", "line", "screen_or_map_field", "call_commarea_field")


@query(f"WITH {sql('fx_sites')}, r AS (SELECT *, row_number() OVER (PARTITION BY program, variable ORDER BY CASE kind WHEN 'write' THEN 1 WHEN 'read' THEN 2 ELSE 3 END, line) AS n FROM fx_sites WHERE line > 0) SELECT program, variable, line FROM r WHERE n = 1")
def first_valid_line(spark, sf_dir):
    return dataflow.first_site_line(_sites(spark))


@query(f"""WITH {sql('fx_vars')}, {sql('fx_sites')}, s AS (SELECT split_part(variable, '-', 1) AS structure, v.*, EXISTS (SELECT 1 FROM fx_sites x WHERE x.program = v.program AND x.variable = v.variable AND kind = 'control') AS c FROM fx_vars v)
SELECT structure, count(DISTINCT program) AS program_count, count(DISTINCT variable) AS variable_count, string_agg(DISTINCT program, ',' ORDER BY program) AS programs, coalesce(string_agg(DISTINCT variable, ',' ORDER BY variable) FILTER (c), '') AS control_variables FROM s WHERE length(structure) > 1 GROUP BY structure""")
def structure_prefixes(spark, sf_dir):
    control = _sites(spark).where("kind = 'control'").select("program", "variable")
    rows = maps.structures(frame(spark, "fx_vars"), control, 1, 1).select("structure", "program_count", "variable_count", "programs", "control_variables")
    return _joined(rows, "programs", "control_variables")


@query(f"""WITH {sql('fx_vars')}, {sql('fx_sites')}, v AS (SELECT v.variable, v.program, bool_or(kind = 'control') AS c FROM fx_vars v LEFT JOIN fx_sites s ON v.program = s.program AND v.variable = s.variable GROUP BY ALL)
SELECT variable, count(*) AS program_count, coalesce(string_agg(program, ',' ORDER BY program) FILTER (c), '') AS controls_flow_programs FROM v GROUP BY variable HAVING count(*) >= 2""")
def shared_between_programs(spark, sf_dir):
    rows = maps.shared_variables(maps.variable_map(frame(spark, "fx_vars"), _sites(spark))).select("variable", "program_count", "controls_flow_programs")
    return _joined(rows, "controls_flow_programs")


@query(f"""WITH {sql('fx_sites')}, c AS (SELECT 'P' AS program, 'c1' AS call_id, 28 AS called, 'A' AS parameter UNION ALL SELECT 'P', 'c1', 28, 'PD1FS00'),
m AS (SELECT c.program, call_id, parameter, s.variable, CASE kind WHEN 'write' THEN 'writes_before' ELSE 'reads_after' END AS side, line, row_number() OVER (PARTITION BY call_id, parameter, s.variable, kind ORDER BY abs(line - called), statement) AS n FROM c JOIN fx_sites s ON s.program = c.program AND (s.variable = parameter OR starts_with(s.variable, parameter || '-')) WHERE (kind = 'write' AND line <= called) OR (kind = 'read' AND line >= called))
SELECT program, call_id, parameter, variable, side, CAST(n AS INTEGER) AS place, line FROM m WHERE n <= 5""")
def writes_and_reads_round_calls(spark, sf_dir):
    """Prefix join, then the nearest five writes before and reads after."""
    calls = spark.createDataFrame([("P", "c1", 28, ["A", "PD1FS00"])], "program string, call_id string, line_start int, parameters array<string>")
    return dataflow.call_parameters(calls, _sites(spark)).select("program", "call_id", "parameter", "variable", "side", "place", "line")


@query()
def review_documents(spark, sf_dir):
    """Documents of a program's variables, literals and calls."""
    r = _program(spark)
    records = dataflow.variable_records(r["variables"], r["sites"])
    calls = r["calls"].withColumn("call_id", short_blake(F.concat_ws("|", "program", "target", F.col("line_start").cast("string"), "statement")))
    out = review.variable_documents(records).unionByName(review.used_variables_documents(records))
    out = out.unionByName(review.literal_documents(dataflow.literal_assignments(r["sites"], r["variables"], records)))
    return out.unionByName(review.call_documents(calls, dataflow.call_parameters(calls, r["sites"]))).select(*_DOCUMENT)


_DOCUMENT = ("id", "type", "program", "title", "embedding_text", "content", "meta")


@query()
def structure_documents(spark, sf_dir):
    """Documents of a program's screens, graph, dead code and copybooks, and of jobs' files."""
    r, a = _program(spark), _jobs(spark)
    reached = graph.reachable_by_program(r["edges"], r["programs"].select("program", F.col("program").alias("node")))
    books = facts.copybooks(_records(spark)).select("program", "name")
    out = review.navigation_documents(graph.screen_actions(r["edges"]), graph.screen_maps(frame(spark, "fx_cobol"), r["programs"]))
    for more in (
        review.graph_documents(r["nodes"], r["edges"]),
        review.dead_code_documents(r["programs"], r["comments"], r["nodes"], reached),
        review.unused_copybook_documents(books, dataflow.copybook_evidence(books, r["variables"], r["sites"])),
        review.job_file_documents(a["steps"], a["step_datasets"]),
        review.screen_documents(dataflow.screen_lineage(r["variables"], r["sites"], r["programs"].select("program", F.lit("PDCUST01").alias("name")))),
    ):
        out = out.unionByName(more)
    return out.select(*_DOCUMENT)


@query(f"WITH {_REASONS} SELECT note || ': ' || n || ' program(s)' AS action, n FROM g")
def next_actions(spark, sf_dir):
    return review.next_actions(quality.top_reasons(_status(spark)))
