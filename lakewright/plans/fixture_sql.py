"""SQL of queries whose operators need several steps: the same rows, derived from the fixtures' lines alone."""

from __future__ import annotations

from ..functions import fixed
from .fixtures import sql


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _list(*items: str) -> str:
    return f"list_filter([{', '.join(items)}], lambda x: x IS NOT NULL)"


def _collapse(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '\\s+', ' ', 'g'))"


SQL: dict[str, str] = {}

# --- job scripts: lines folded to statements by a recursive query, then relations over them ------------

_OUT = "^((?:[^'']|''[^'']*(?:''|$))*?)"
_ITEM = r"((?:[^,()'']|''[^'']*(?:''|$)|\((?:[^()'']|''[^'']*''|\((?:[^()'']|''[^'']*''|\([^()]*\))*\))*(?:\)|$)|\))+)"
_FIRST = "upper(regexp_extract({0}, '^\\s*(\\S+)', 1))"
_KW = "kw['{0}']"
_STEM = "upper(regexp_replace(regexp_extract(file, '([^/]*)$', 1), '\\.[^.]*$', ''))"

_STATEMENTS = f"""{sql('fx_jcl')}, jl AS (SELECT file, line_no, upper(trim(substr(raw, 3, 8))) AS label, regexp_matches(substr(raw, 3, 1), '^\\s$') AS free,
 trim(CASE WHEN regexp_matches(substr(raw, 3, 1), '^\\s$') THEN substr(raw, 3) ELSE substr(raw, 11) END) AS t FROM (SELECT file, line_no, rtrim(raw) AS raw FROM fx_jcl) WHERE starts_with(raw, '//') AND NOT starts_with(raw, '//*')),
j1 AS (SELECT *, regexp_matches(t, '{_OUT}(?:<==|\\*\\*)') AS cut FROM jl),
j2 AS (SELECT *, rtrim(CASE WHEN cut THEN regexp_extract(t, '{_OUT}(?:<==|\\*\\*)(.*)$', 1) ELSE t END) AS t1, CASE WHEN cut THEN {_collapse(f"regexp_extract(t, '{_OUT}(?:<==|[*][*])(.*)$', 2)")} ELSE '' END AS note1 FROM j1),
j3 AS (SELECT *, regexp_matches(t1, '{_OUT}  ') AS more FROM j2),
jr AS (SELECT file, line_no, label, free, rtrim(CASE WHEN more THEN regexp_extract(t1, '{_OUT}  ', 1) ELSE t1 END) AS text,
 list_filter([note1, CASE WHEN more THEN {_collapse(f"regexp_extract(t1, '{_OUT}(  .*)$', 2)")} ELSE '' END], lambda x: x <> '') AS notes, row_number() OVER (PARTITION BY file ORDER BY line_no) AS rn FROM j3),
fold AS (SELECT file, rn, 1 AS seq, CASE WHEN free THEN '' ELSE label END AS label, text, notes, line_no AS start_line, line_no AS end_line, FALSE AS implicit_label FROM jr WHERE rn = 1
 UNION ALL SELECT r.file, r.rn, f.seq + CASE WHEN k = 'more' THEN 0 ELSE 1 END, CASE k WHEN 'begins' THEN r.label WHEN 'control' THEN '' ELSE f.label END, CASE WHEN k = 'more' THEN trim(f.text || ' ' || r.text) ELSE r.text END,
  CASE WHEN k = 'more' THEN list_concat(f.notes, r.notes) ELSE r.notes END, CASE WHEN k = 'more' THEN f.start_line ELSE r.line_no END, r.line_no, CASE k WHEN 'more' THEN f.implicit_label ELSE k = 'again' END
 FROM fold f JOIN (SELECT *, {_FIRST.format('text')} AS word FROM jr) r ON r.file = f.file AND r.rn = f.rn + 1,
  LATERAL (SELECT CASE WHEN NOT r.free AND r.label <> '' THEN 'begins' WHEN r.word = 'DD' AND {_FIRST.format('f.text')} = 'DD' THEN 'again' WHEN r.word IN ({_in(fixed.CONTROL_OPERATIONS)}) THEN 'control' ELSE 'more' END AS k) AS w),
st AS (SELECT file, seq, label, {_FIRST.format('text')} AS operation, trim(regexp_replace(text, '^\\s*\\S+', '')) AS operands, text, list_filter(notes, lambda x, i: list_position(notes, x) = i) AS notes, start_line, end_line, implicit_label
 FROM (SELECT *, row_number() OVER (PARTITION BY file, seq ORDER BY rn DESC) AS back FROM fold) WHERE back = 1),
ctx AS (SELECT *, coalesce(arg_max(CASE WHEN operation = 'JOB' AND label <> '' THEN label END, CASE WHEN operation = 'JOB' AND label <> '' THEN seq END) OVER (PARTITION BY file), {_STEM}) AS job,
 nullif(last_value(CASE WHEN operation = 'PROC' THEN coalesce(nullif(label, ''), nullif(upper(trim(operands)), ''), 'PROC') WHEN operation = 'PEND' THEN '' END IGNORE NULLS) OVER w, '') AS in_proc,
 nullif(last_value(CASE WHEN operation = 'EXEC' THEN seq WHEN operation <> 'DD' THEN -1 END IGNORE NULLS) OVER w, -1) AS step_seq,
 list_filter(list_transform(regexp_extract_all(operands, '{_ITEM}', 1), lambda x: trim(x)), lambda x: x <> '') AS items FROM st WINDOW w AS (PARTITION BY file ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
o0 AS (SELECT * EXCLUDE (items), list_filter(items, lambda x: NOT contains(x, '=')) AS bare_items, list_transform(list_filter(items, lambda x: contains(x, '=')), lambda x: {{'k': upper(trim(split_part(x, '=', 1))),
 'v': CASE WHEN regexp_matches(trim(regexp_extract(x, '^[^=]*=(.*)$', 1)), '^''.*''$') THEN trim(regexp_extract(x, '^[^=]*=(.*)$', 1)) ELSE trim(regexp_replace(trim(regexp_extract(x, '^[^=]*=(.*)$', 1)), '\\s{{2,}}.*$', '')) END}}) AS kv FROM ctx),
op AS (SELECT *, map_from_entries(list_filter(kv, lambda p, i: len(list_filter(kv[i + 1:], lambda q: q.k = p.k)) = 0)) AS kw FROM o0),
pr AS (SELECT file, procedure, max(end_line) AS end_line FROM (SELECT file, in_proc AS procedure, end_line FROM op WHERE in_proc IS NOT NULL) WHERE (file, procedure) IN (SELECT (file, in_proc) FROM op WHERE operation = 'PROC') GROUP BY ALL),
stp AS (SELECT o.*, coalesce(program, proc) AS target, CASE WHEN program IS NOT NULL THEN 'program' WHEN proc IS NOT NULL THEN 'procedure' ELSE 'unknown' END AS exec_kind, proc IS NOT NULL AND EXISTS (SELECT 1 FROM pr WHERE pr.file = o.file AND pr.procedure = o.proc) AS resolved_locally
 FROM (SELECT file, job, seq, label AS step, CASE WHEN in_proc IS NULL THEN 'job' ELSE 'procedure_definition' END AS scope, in_proc AS defined_in_proc, nullif(upper(trim({_KW.format('PGM')})), '') AS program,
  coalesce(nullif(upper(trim({_KW.format('PROC')})), ''), CASE WHEN nullif(upper(trim({_KW.format('PGM')})), '') IS NULL THEN nullif(upper(trim(bare_items[1])), '') END) AS proc, list_filter(kv, lambda p: p.k NOT IN ('PGM', 'PROC')) AS parameters, notes, start_line, end_line FROM op WHERE operation = 'EXEC') o),
df AS (SELECT o.file, o.job, o.step_seq, row_number() OVER (PARTITION BY o.file, o.step_seq ORDER BY o.seq) AS dd_ordinal, o.label AS ddname, o.implicit_label AS concatenated, {_KW.format('DSN')} AS dsn, {_KW.format('DISP')} AS disp, {_KW.format('SYSOUT')} AS sysout, o.text AS raw,
 s.step, s.scope, s.program FROM op o JOIN stp s ON s.file = o.file AND s.seq = o.step_seq WHERE o.operation = 'DD' AND o.step_seq IS NOT NULL),
dn AS (SELECT *, upper(replace(coalesce(disp, ''), ' ', '')) AS d, trim(split_part(regexp_replace(upper(trim(coalesce(disp, ''))), '^\\((.*)\\)$', '\\1'), ',', 1)) AS dstatus, coalesce(dsn, '') <> '' AS has FROM df),
da AS (SELECT *, CASE WHEN coalesce(sysout, '') <> '' THEN 'sysout:SYSOUT destination' WHEN contains(upper(raw), 'DUMMY') AND NOT has THEN 'control:DUMMY DD' WHEN ddname IN ({_in(fixed.CONTROL_DD)}) THEN 'control:Control DD name' WHEN program = 'IEFBR14' AND contains(d, 'DELETE') THEN 'delete:IEFBR14 cleanup pattern'
 WHEN ddname IN ({_in(fixed.READ_DD)}) THEN 'read:Input DD name' WHEN ddname IN ({_in(fixed.WRITE_DD)}) THEN 'write:Output DD name' WHEN dstatus IN ('OLD', 'SHR') THEN 'read:DISP references an existing dataset' WHEN dstatus IN ('NEW', 'MOD') THEN 'write:DISP creates or updates a dataset'
 WHEN starts_with(d, '(,') OR contains(d, '(,CATLG') OR contains(d, '(,PASS') THEN 'write:DISP implies dataset creation' WHEN has THEN 'unknown:Dataset present but access is ambiguous' ELSE 'control:Non-dataset DD' END AS a,
 CASE WHEN NOT has THEN NULL WHEN starts_with(upper(dsn), '&&') THEN 'temporary' WHEN starts_with(upper(dsn), 'SYS1.') OR starts_with(upper(dsn), 'SYSOUT') THEN 'system' ELSE 'persistent' END AS dataset_kind FROM dn),
dd AS (SELECT *, split_part(a, ':', 1) AS access_type, split_part(a, ':', 2) AS access_reason FROM da),
ex AS (SELECT file, seq, step, execution_scope, invoked_by_step, invoked_proc, row_number() OVER (PARTITION BY file ORDER BY outer_seq, seq) AS execution_order FROM (
 SELECT o.file, o.seq AS outer_seq, coalesce(i.seq, o.seq) AS seq, coalesce(i.step, o.step) AS step, CASE WHEN i.seq IS NULL THEN 'job' ELSE 'expanded_local_procedure' END AS execution_scope, CASE WHEN i.seq IS NOT NULL THEN o.step END AS invoked_by_step, CASE WHEN i.seq IS NOT NULL THEN o.proc END AS invoked_proc
 FROM stp o LEFT JOIN stp i ON o.exec_kind = 'procedure' AND o.resolved_locally AND i.file = o.file AND i.defined_in_proc = o.proc WHERE o.scope = 'job')),
us AS (SELECT e.file, e.step, e.execution_order, d.job, d.dsn, d.dd_ordinal, d.access_type, d.dataset_kind FROM ex e JOIN dd d ON d.file = e.file AND d.step_seq = e.seq WHERE d.dsn <> ''),
lost AS (SELECT file, proc, min(seq) AS at FROM stp WHERE proc IS NOT NULL AND NOT resolved_locally GROUP BY ALL)"""


def _jobs(select: str) -> str:
    return f"WITH RECURSIVE {_STATEMENTS} {select}"


SQL["jcl_statements"] = _jobs("SELECT file, CAST(seq AS INTEGER) AS seq, label, operation, operands, text, array_to_string(notes, ',') AS notes, start_line, end_line, implicit_label FROM st")
SQL["jcl_steps"] = _jobs("""SELECT file, job, CAST(seq AS INTEGER) AS seq, step, scope, defined_in_proc, exec_kind, target, program, proc,
 '{' || array_to_string(list_transform(parameters, lambda p: '"' || p.k || '":"' || replace(p.v, '"', '\\"') || '"'), ',') || '}' AS parameters, array_to_string(notes, ',') AS notes, start_line, end_line, resolved_locally FROM stp""")
SQL["jcl_access"] = _jobs("SELECT file, step, CAST(dd_ordinal AS INTEGER) AS dd_ordinal, ddname, concatenated, dsn, access_type, access_reason, dataset_kind, dataset_kind = 'temporary' AS is_temporary FROM dd")
SQL["jcl_execution"] = _jobs("SELECT file, CAST(seq AS INTEGER) AS seq, step, execution_scope, invoked_by_step, invoked_proc, CAST(execution_order AS INTEGER) AS execution_order FROM ex")


def _steps_of(access: str) -> str:
    return f"coalesce(string_agg(step, ',' ORDER BY execution_order, dd_ordinal) FILTER (access_type = '{access}'), '')"


_CATALOG = f"""SELECT file, job, dsn, (list(dataset_kind ORDER BY execution_order, dd_ordinal) FILTER (dataset_kind IS NOT NULL))[1] AS dataset_kind, bool_or(access_type IN ('read', 'control') AND (fw IS NULL OR execution_order < fw)) AS external_input,
 {_steps_of('write')} AS produced_by, {_steps_of('read')} AS consumed_by, {_steps_of('control')} AS controlled_by, {_steps_of('delete')} AS deleted_by, count(*) AS n_usages, CAST(min(fw) AS INTEGER) AS first_write_order
 FROM (SELECT *, min(execution_order) FILTER (access_type = 'write') OVER (PARTITION BY file, dsn) AS fw FROM us) GROUP BY file, job, dsn"""
SQL["jcl_catalog"] = _jobs(_CATALOG)
SQL["jcl_lineage"] = _jobs("""SELECT DISTINCT file, job, from_step, step AS to_step, dsn, CASE access_type WHEN 'read' THEN 'produces_input_for' ELSE 'deleted_after' END AS flow_type FROM (
 SELECT *, last_value(CASE WHEN access_type = 'write' THEN step END IGNORE NULLS) OVER (PARTITION BY file, dsn ORDER BY execution_order, dd_ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS from_step FROM us) WHERE access_type IN ('read', 'delete') AND from_step IS NOT NULL""")


def _first_of(filter_: str, value: str, name: str) -> str:
    """Distinct values in the order of their first definition."""
    return f"coalesce((SELECT string_agg(v, ',' ORDER BY place) FROM (SELECT {value} AS v, min(dd_ordinal) AS place FROM dd x WHERE x.file = g.file AND x.step_seq = g.step_seq AND {filter_} GROUP BY 1)), '') AS {name}"


_ACCESS = {"read": "reads", "write": "writes", "delete": "deletes", "control": "controls", "unknown": "unknowns"}
_LISTS = ", ".join(_first_of(f"has AND access_type = '{a}'", "dsn", n) for a, n in _ACCESS.items())
_SYSOUTS = _first_of("access_type = 'sysout'", "coalesce(nullif(ddname, ''), 'SYSOUT')", "sysouts")
_STEP_DATASETS = f"SELECT file, CAST(step_seq AS INTEGER) AS step_seq, {_LISTS}, {_SYSOUTS} FROM (SELECT DISTINCT file, step_seq FROM dd) g"
SQL["jcl_step_datasets"] = _jobs(_STEP_DATASETS)
SQL["jcl_symbols"] = _jobs("SELECT file, symbol, arg_max(value, seq) AS value FROM (SELECT file, seq, unnest(kv).k AS symbol, unnest(kv).v AS value FROM op WHERE operation = 'SET') GROUP BY ALL")
SQL["jcl_procedures"] = _jobs("""SELECT p.procedure, p.file AS source, c.job, coalesce(string_agg(DISTINCT s.program, ',' ORDER BY s.program), '') AS programs, count(s.seq) AS steps_count FROM pr p JOIN (SELECT DISTINCT file, job FROM op) c ON c.file = p.file LEFT JOIN stp s ON s.file = p.file AND s.defined_in_proc = p.procedure GROUP BY ALL""")
SQL["jcl_file_use"] = _jobs(f"""SELECT s.file, s.job, s.step, s.program, d.reads, d.writes, d.deletes FROM stp s LEFT JOIN ({_STEP_DATASETS}) d ON d.file = s.file AND d.step_seq = s.seq WHERE s.program = 'IEFBR14'""")
_VALID = f"""v0 AS (SELECT f.file, (SELECT min(job) FROM op WHERE op.file = f.file) AS job, coalesce((SELECT string_agg(DISTINCT program, ',' ORDER BY program) FROM stp WHERE stp.file = f.file), '') AS programs,
 (SELECT count(*) FROM ex WHERE ex.file = f.file) AS execution_steps_count, (SELECT count(DISTINCT (job, dsn)) FROM us WHERE us.file = f.file) AS datasets_count, (SELECT count(*) FROM op WHERE op.file = f.file AND operation IN ({_in(fixed.CONTROL_OPERATIONS)})) AS control_statements_count,
 (SELECT count(*) FROM lost WHERE lost.file = f.file AND EXISTS (SELECT 1 FROM pr WHERE pr.procedure = lost.proc AND pr.file <> lost.file)) AS n_batch_resolvable,
 (SELECT count(*) FROM lost WHERE lost.file = f.file AND NOT EXISTS (SELECT 1 FROM pr WHERE pr.procedure = lost.proc AND pr.file <> lost.file)) AS n_unresolved,
 (SELECT count(*) FROM dd WHERE dd.file = f.file AND access_type = 'unknown' AND dsn <> '') AS n_unknown_dd FROM (SELECT DISTINCT file FROM fx_jcl) f),
v1 AS (SELECT *, programs = '' AS zero_parsed_programs FROM v0),
v2 AS (SELECT *, {_list("CASE WHEN n_batch_resolvable > 0 THEN 'procedure_resolvable_in_batch' END", "CASE WHEN n_unresolved > 0 THEN 'unresolved_procedure' END", "CASE WHEN zero_parsed_programs THEN 'zero_parsed_programs' END", "CASE WHEN n_unknown_dd > 0 THEN 'unknown_dd_usage' END")} AS fl FROM v1),
vd AS (SELECT * EXCLUDE (fl), array_to_string(fl, ',') AS flags, CASE WHEN len(list_filter(fl, lambda x: x <> 'procedure_resolvable_in_batch')) > 0 THEN 'warning' ELSE 'ok' END AS status FROM v2)"""
SQL["jcl_validation"] = f"WITH RECURSIVE {_STATEMENTS}, {_VALID} SELECT * FROM vd"
SQL["jcl_validation_summary"] = f"""WITH RECURSIVE {_STATEMENTS}, {_VALID} SELECT count(*) AS files_checked, count(*) AS files_parsed, CAST(0 AS BIGINT) AS parse_errors, count(*) FILTER (flags <> '') AS files_with_flags, count(*) FILTER (status = 'warning') AS files_with_warnings,
 count(*) FILTER (n_unresolved > 0) AS files_with_unresolved_procedures, count(*) FILTER (n_batch_resolvable > 0) AS files_with_batch_resolvable_procedures, count(*) FILTER (zero_parsed_programs) AS files_with_zero_parsed_programs, count(*) FILTER (n_unknown_dd > 0) AS files_with_unknown_dd_usage FROM vd"""

# --- control flow ---------------------------------------------------------------------------------------

_FLOW_WORDS = _in(sorted(fixed.FLOW_WORDS))
_RANGE = "\\bPERFORM\\b\\s+([A-Z0-9-]+)\\s+(?:THRU|THROUGH)\\s+([A-Z0-9-]+)"
_GO = "coalesce(nullif(regexp_extract(u, '\\bGO\\s+TO\\b\\s+(.+)', 1), ''), regexp_extract(u, '\\bGOTO\\b\\s+(.+)', 1))"
_FLOW = f"""{sql('fx_cobol')}, prog AS (SELECT file, upper(regexp_extract(string_agg(raw, chr(10) ORDER BY line_no), '(?i)PROGRAM-ID\\.\\s*([A-Z0-9-]+)\\.', 1)) AS program FROM fx_cobol GROUP BY file),
c0 AS (SELECT file, line_no, substr(rpad(raw, 80, ' '), 7, 1) AS ind, rtrim(substr(rpad(raw, 80, ' '), 8, 65)) AS code FROM fx_cobol),
c1 AS (SELECT file, line_no, ind, CASE WHEN contains(code, '*>') THEN rtrim(split_part(code, '*>', 1)) ELSE code END AS code FROM c0 WHERE ind NOT IN ('*', '/', 'D')),
c2 AS (SELECT *, sum(CASE WHEN ind = '-' THEN 0 ELSE 1 END) OVER (PARTITION BY file ORDER BY line_no) AS part FROM c1 WHERE code <> ''),
s0 AS (SELECT file, min(line_no) AS line, trim(string_agg(trim(code), ' ' ORDER BY line_no)) AS statement FROM c2 GROUP BY file, part),
s1 AS (SELECT *, upper(statement) AS u, regexp_extract(upper(statement), '^\\s*(IDENTIFICATION|ENVIRONMENT|DATA|PROCEDURE)\\s+DIVISION\\b', 1) = 'PROCEDURE' AS header FROM s0),
s2 AS (SELECT *, max(CASE WHEN header THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY line) AS body, regexp_extract(u, '^\\s*([A-Z][A-Z0-9-]{{1,30}})\\.\\s*$', 1) AS word FROM s1),
s3 AS (SELECT file, line, statement, u, CASE WHEN word <> '' AND word NOT IN ({_FLOW_WORDS}) THEN word END AS label FROM s2 WHERE body = 1 AND NOT header),
ords AS (SELECT file, paragraph, row_number() OVER (PARTITION BY file ORDER BY first) - 1 AS ord FROM (SELECT file, paragraph, min(line) AS first FROM (SELECT file, program AS paragraph, 0 AS line FROM prog UNION ALL SELECT file, label, line FROM s3 WHERE label IS NOT NULL) GROUP BY ALL)),
b0 AS (SELECT s3.file, line, statement, u, label, coalesce(last_value(label IGNORE NULLS) OVER (PARTITION BY s3.file ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), program) AS paragraph FROM s3 JOIN prog USING (file)),
b1 AS (SELECT b0.file, line, statement, u, b0.paragraph, ord, nullif(regexp_extract(u, '{_RANGE}', 1), '') AS rs, nullif(regexp_extract(u, '{_RANGE}', 2), '') AS re, nullif(regexp_extract(u, '\\bPERFORM\\b\\s+([A-Z0-9-]+)\\b', 1), '') AS pf FROM b0 JOIN ords USING (file, paragraph) WHERE label IS NULL),
b2 AS (SELECT *, coalesce(rs, CASE WHEN pf NOT IN ('UNTIL', 'VARYING', 'TEST') THEN pf END) AS target FROM b1),
b3 AS (SELECT *, CASE WHEN target IS NOT NULL THEN target WHEN contains(u, 'PERFORM') AND regexp_matches(u, ' UNTIL | VARYING ') THEN paragraph END AS own,
 CASE WHEN contains(u, 'NEXT SENTENCE') THEN [] ELSE list_filter(regexp_extract_all(replace(split_part({_GO}, 'DEPENDING', 1), '.', ' '), '\\b([A-Z][A-Z0-9-]*)\\b', 1), lambda t: t NOT IN ({_FLOW_WORDS})) END AS gone FROM b2),
e0 AS (SELECT file, paragraph AS src, own AS dst, 0 AS stage, ord, line, 0 AS pos FROM b3 WHERE own IS NOT NULL UNION ALL SELECT file, paragraph, unnest(gone), 0, ord, line, unnest(generate_series(1, len(gone))) FROM b3),
nx AS (SELECT file, paragraph AS src, ord, lead(paragraph) OVER (PARTITION BY file ORDER BY ord) AS dst FROM ords),
rg AS (SELECT file, target AS range_start, re AS range_end, min({{'ord': ord, 'line': line}}) AS k FROM b3 WHERE re IS NOT NULL GROUP BY ALL),
e1 AS (SELECT n.file, n.src, n.dst, 1 AS stage, r.k.ord AS ord, r.k.line AS line, n.ord AS pos FROM rg r JOIN ords a ON a.file = r.file AND a.paragraph = r.range_start JOIN ords z ON z.file = r.file AND z.paragraph = r.range_end JOIN nx n ON n.file = r.file AND n.ord >= a.ord AND n.ord + 1 <= z.ord WHERE a.ord <= z.ord AND n.dst IS NOT NULL),
la AS (SELECT file, paragraph AS src, arg_max(trim(u), line) AS last FROM b3 GROUP BY ALL),
e2 AS (SELECT n.file, n.src, n.dst, 2 AS stage, n.ord, 0 AS line, 0 AS pos FROM nx n LEFT JOIN la USING (file, src) WHERE n.dst IS NOT NULL AND (last IS NULL OR NOT (regexp_matches(last, '^(GO TO |GOTO |STOP RUN|GOBACK|EXIT PROGRAM|RETURN)') OR (starts_with(last, 'EXEC CICS') AND regexp_matches(last, ' RETURN| XCTL'))))),
pairs AS (SELECT file, src, dst, min({{'stage': stage, 'ord': ord, 'line': line, 'pos': pos}}) AS k FROM (SELECT * FROM e0 UNION ALL SELECT * FROM e1 UNION ALL SELECT * FROM e2) GROUP BY ALL),
edges AS (SELECT program, row_number() OVER (PARTITION BY program ORDER BY k) AS edge_no, src, dst FROM pairs JOIN prog USING (file))"""
SQL["control_flow_edges"] = f"WITH {_FLOW} SELECT program, CAST(edge_no AS INTEGER) AS edge_no, src, dst FROM edges"
SQL["control_flow_nodes"] = f"WITH {_FLOW} SELECT program, paragraph AS node FROM ords JOIN prog USING (file) UNION SELECT program, dst FROM edges"

# --- statements ended by what they hold, folded by a recursive query; calls in them ----------------------

_LABEL = "^\\s*([A-Z0-9][A-Z0-9-]*)\\.\\s*$"
_NAME = "(''[^'']+''|\"[^\"]+\"|[A-Z0-9-]+)"
_USING = f"(?i)\\bCALL\\s+{_NAME}\\s+USING\\s+(.+?)(?:\\.|$)"
_ENDED = f"""{sql('fx_cobol')}, prog AS (SELECT file, upper(regexp_extract(string_agg(raw, chr(10) ORDER BY line_no), '(?i)PROGRAM-ID\\.\\s*([A-Z0-9-]+)\\.', 1)) AS program FROM fx_cobol GROUP BY file),
t0 AS (SELECT file, line_no, trim(raw) AS text, CASE WHEN regexp_matches(raw, '{_LABEL}') AND upper(regexp_extract(raw, '{_LABEL}', 1)) NOT IN ({_in(sorted(fixed.NOT_PARAGRAPHS))}) THEN regexp_extract(raw, '{_LABEL}', 1) END AS label FROM fx_cobol WHERE NOT regexp_matches(trim(raw), '^[*/]')),
t1 AS (SELECT *, coalesce(last_value(label IGNORE NULLS) OVER (PARTITION BY file ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS paragraph FROM t0),
t2 AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY line_no) AS rn FROM t1 WHERE label IS NULL AND text <> '' AND NOT regexp_matches(text, '^(?i)(SKIP\\d*|EJECT)$')),
g AS (SELECT file, rn, paragraph, line_no AS line_start, line_no AS line_end, text AS whole FROM t2 WHERE rn = 1
 UNION ALL SELECT t.file, t.rn, t.paragraph, CASE WHEN done THEN t.line_no ELSE g.line_start END, t.line_no, CASE WHEN done THEN t.text ELSE g.whole || ' ' || t.text END
 FROM g JOIN t2 t ON t.file = g.file AND t.rn = g.rn + 1, LATERAL (SELECT CASE WHEN contains(upper(g.whole), 'EXEC CICS') THEN contains(upper(g.whole), 'END-EXEC') ELSE regexp_matches(g.whole, '(?i)\\bCALL\\s+{_NAME}\\s+USING\\b') OR ends_with(g.whole, '.') END AS done) AS d),
ended AS (SELECT file, paragraph, line_start, line_end, {_collapse('whole')} AS statement FROM g WHERE CASE WHEN contains(upper(whole), 'EXEC CICS') THEN contains(upper(whole), 'END-EXEC') ELSE regexp_matches(whole, '(?i)\\bCALL\\s+{_NAME}\\s+USING\\b') OR ends_with(whole, '.') END)"""


def _bare(c: str) -> str:
    return f"trim({c}, chr(39) || chr(34))"


def _option(word: str) -> str:
    return f"nullif(upper(regexp_extract(block, '(?i)\\b{word}\\s*\\(\\s*([A-Z0-9-]+)\\s*\\)', 1)), '')"


_CALLS = f"""{_ENDED}, bl AS (SELECT *, unnest(regexp_extract_all(statement, '(?i)\\b(EXEC\\s+CICS\\s+(?:LINK|XCTL)\\b.*?\\bEND-EXEC)\\b', 1)) AS block FROM ended),
calls AS (SELECT file, paragraph, line_start, line_end, statement, 'CICS' || upper(regexp_extract(block, '(?i)CICS\\s+(LINK|XCTL)', 1)) AS call_type, {_bare(f"regexp_extract(block, '(?i)[ ]PROGRAM[ ]*[(][ ]*{_NAME}[ ]*[)]', 1)")} AS target,
 coalesce({_option('COMMAREA')}, '') AS parameters, {_option('COMMAREA')} AS commarea, {_option('LENGTH')} AS length FROM bl
 UNION ALL SELECT file, paragraph, line_start, line_end, statement, 'CALL', upper({_bare(f"regexp_extract(statement, '{_USING}', 1)")}),
 array_to_string(list_filter(list_transform(regexp_split_to_array(regexp_extract(statement, '{_USING}', 2), '\\s+'), lambda x: upper(rtrim(x, '.'))), lambda x: x NOT IN ('', 'BY', 'REFERENCE', 'CONTENT', 'VALUE')), ','), NULL, NULL FROM ended WHERE regexp_matches(statement, '{_USING}'))"""
SQL["outgoing_calls"] = f"WITH RECURSIVE {_CALLS} SELECT paragraph, line_start, line_end, statement, call_type, target, parameters, commarea, length, program FROM calls JOIN prog USING (file) WHERE target <> ''"

# --- conditions of jumps and typed edges: ladders of one-line IFs, as the fixture's paragraphs have -------

_RAW = """l0 AS (SELECT file, line_no, rtrim(raw) AS raw, line_no > coalesce(min(CASE WHEN regexp_matches(upper(raw), '^\\s*PROCEDURE\\s+DIVISION\\.\\s*$') THEN line_no END) OVER (PARTITION BY file), 0) AS body FROM fx_cobol),
l1 AS (SELECT l0.*, program, nullif(upper(regexp_extract(raw, '(?i)^\\s*([A-Z0-9-]+)\\s*\\.\\s*$', 1)), '') AS name FROM l0 JOIN prog USING (file) WHERE body AND NOT starts_with(trim(raw), '*')),
l2 AS (SELECT *, coalesce(last_value(name IGNORE NULLS) OVER (PARTITION BY file ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), program) AS src FROM l1),
pl AS (SELECT program, src, line_no, raw, upper(raw) AS u FROM l2 WHERE name IS NULL),
ro AS (SELECT program, paragraph, row_number() OVER (PARTITION BY program ORDER BY first) - 1 AS ord FROM (SELECT program, paragraph, min(line) AS first FROM (SELECT program, program AS paragraph, 0 AS line FROM prog UNION ALL SELECT program, name, line_no FROM l1 WHERE name IS NOT NULL) GROUP BY ALL)),
if0 AS (SELECT program, src, line_no, regexp_matches(u, '^\\s*IF\\b') AS is_if, trim(split_part(regexp_replace(raw, '(?i)^\\s*IF\\b', ''), ' THEN', 1)) AS told, nullif(regexp_extract(u, '\\bGO\\s+TO\\s+([A-Z0-9-]+)', 1), '') AS dst FROM pl),
if1 AS (SELECT *, lag(is_if) OVER w AS after_if, lag(told) OVER w AS guard, regexp_split_to_array(told, '\\s+OR\\s+') AS terms FROM if0 WINDOW w AS (PARTITION BY program, src ORDER BY line_no)),
if2 AS (SELECT *, CASE WHEN is_if THEN list_transform(terms, lambda x: CASE WHEN contains(x, ' = ') THEN x ELSE regexp_extract(terms[1], '^(.*\\S\\s+=)', 1) || ' ' || x END) END AS said FROM if1),
if3 AS (SELECT *, lag(said) OVER (PARTITION BY program, src ORDER BY line_no) AS held, flatten(list(said) FILTER (is_if) OVER (PARTITION BY program, src ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS ladder FROM if2),
jc0 AS (SELECT program, src, dst, line_no, CASE WHEN after_if THEN held WHEN len(ladder) > 0 THEN ['NOT (' || array_to_string(ladder, ' OR ') || ')'] END AS parts FROM if3 WHERE dst IS NOT NULL),
jc1 AS (SELECT program, src, dst, flatten(list(parts ORDER BY line_no)) AS parts FROM jc0 WHERE parts IS NOT NULL GROUP BY ALL),
jc AS (SELECT program, src, dst, CASE WHEN len(parts) = 1 THEN parts[1] ELSE array_to_string(list_transform(parts, lambda x: '(' || x || ')'), ' OR ') END AS condition FROM jc1)"""
SQL["jump_conditions"] = f"WITH {_FLOW}, {_RAW} SELECT program, src, dst, condition FROM jc"

_THRU = "\\bPERFORM\\b\\s+([A-Z0-9-]+)\\s+\\bTHRU\\b\\s+([A-Z0-9-]+)"
_EDGES = f"""{_FLOW}, {_RAW},
r0 AS (SELECT program, src, line_no, trim(raw) AS evidence, regexp_extract(u, '{_THRU}', 1) AS a, regexp_extract(u, '{_THRU}', 2) AS z, CASE WHEN contains(u, 'THRU') THEN '' ELSE regexp_extract(u, '\\bPERFORM\\b\\s+([A-Z0-9-]+)\\b', 1) END AS single, regexp_extract(u, '\\bGO\\s+TO\\b\\s+([A-Z0-9-]+)', 1) AS jump FROM pl),
r1 AS (SELECT program, src, a AS dst, line_no, 0 AS rank, 'CALL_RANGE' AS type, evidence, a, z FROM r0 UNION ALL SELECT program, src, z, line_no, 0, 'CALL_RANGE', evidence, a, z FROM r0 UNION ALL SELECT program, src, single, line_no, 1, 'CALL', evidence, NULL, NULL FROM r0 UNION ALL SELECT program, src, jump, line_no, 2, 'JUMP', evidence, NULL, NULL FROM r0),
r2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY program, src, dst ORDER BY line_no, rank) AS n FROM r1 WHERE dst <> '') WHERE n = 1),
vb AS (SELECT program, src AS paragraph, string_agg(DISTINCT v, ',' ORDER BY v) AS ops FROM (SELECT program, src, unnest(regexp_extract_all(string_agg(u, ' ' ORDER BY line_no), '\\bEXEC\\s+CICS\\s+([A-Z]+)\\b', 1)) AS v FROM pl GROUP BY program, src) WHERE v IN ({_in(fixed.MONITOR_VERBS)}) GROUP BY ALL),
pf AS (SELECT DISTINCT program, a, z FROM r0 WHERE a <> ''),
x0 AS (SELECT e.*, coalesce(r.type, 'FALLTHROUGH') AS type, r.evidence, r.a AS range_start, r.z AS range_end FROM edges e LEFT JOIN r2 r ON r.program = e.program AND r.src = e.src AND r.dst = e.dst),
x1 AS (SELECT x.*, (SELECT '[' || string_agg('{{"start":"' || f.a || '","end":"' || f.z || '"}}', ',' ORDER BY f.a, f.z) || ']' FROM pf f JOIN ro s ON s.program = f.program AND s.paragraph = f.a JOIN ro t ON t.program = f.program AND t.paragraph = f.z JOIN ro o ON o.program = x.program AND o.paragraph = x.src JOIN ro p ON p.program = x.program AND p.paragraph = x.dst
 WHERE f.program = x.program AND x.type = 'FALLTHROUGH' AND p.ord = o.ord + 1 AND o.ord >= s.ord AND p.ord <= t.ord) AS range_flow_of FROM x0 x),
rich AS (SELECT x.program, CAST(edge_no AS INTEGER) AS edge_no, x.src, x.dst, CASE WHEN range_flow_of IS NOT NULL THEN 'RANGE_FLOW' ELSE type END AS type,
 CASE WHEN type = 'JUMP' THEN CASE WHEN regexp_matches(upper(c.condition), ' AND | OR | NOT ') AND NOT starts_with(c.condition, '(') THEN '(' || c.condition || ')' ELSE c.condition END END AS condition,
 range_start, range_end, CASE WHEN type IN ('CALL', 'CALL_RANGE') THEN coalesce(v.ops, '') ELSE '' END AS cics_ops, evidence, range_flow_of FROM x1 x LEFT JOIN jc c ON c.program = x.program AND c.src = x.src AND c.dst = x.dst LEFT JOIN vb v ON v.program = x.program AND v.paragraph = x.dst)"""
SQL["enriched_edges"] = f"WITH {_EDGES} SELECT * FROM rich"

# --- sites of variables ---------------------------------------------------------------------------------

_DATA_WORDS = _in(sorted(fixed.DATAFLOW_WORDS))
_IS_DATA = f"(starts_with({{0}}, 'DFH') OR starts_with({{0}}, 'EIB') OR {{0}} NOT IN ({_DATA_WORDS}))"


def _ids(c: str) -> str:
    bare = f"""regexp_replace(regexp_replace(upper({c}), '''[^'']*''', ' ', 'g'), '"[^"]*"', ' ', 'g')"""
    return f"list_filter(regexp_extract_all({bare}, '\\b([A-Z][A-Z0-9-]*)\\b', 1), lambda t: length(t) > 1 AND {_IS_DATA.format('t')})"


def _after(c: str, word: str) -> str:
    return f"substr({c}, strpos({c}, '{word}') + {len(word)})"


_DIVIDED = """y0 AS (SELECT file, line_no, substr(rpad(raw, 80, ' '), 7, 1) AS ind, rtrim(substr(rpad(raw, 80, ' '), 8, 65)) AS code FROM fx_cobol),
y1 AS (SELECT *, sum(CASE WHEN ind = '-' THEN 0 ELSE 1 END) OVER (PARTITION BY file ORDER BY line_no) AS part FROM y0 WHERE ind NOT IN ('*', '/') AND code <> ''),
y2 AS (SELECT file, min(line_no) AS line, trim(string_agg(trim(code), ' ' ORDER BY line_no)) AS statement FROM y1 GROUP BY file, part),
y3 AS (SELECT *, upper(statement) AS u, nullif(regexp_extract(upper(statement), '^\\s*(IDENTIFICATION|ENVIRONMENT|DATA|PROCEDURE)\\s+DIVISION\\b', 1), '') AS h, nullif(regexp_extract(upper(statement), '^\\s*([A-Z0-9-]+)\\s+SECTION\\.\\s*$', 1), '') AS sec,
 regexp_extract(upper(statement), '^\\s*([0-9]{2})\\s+([A-Z][A-Z0-9-]+)\\b', 1) AS lv, regexp_extract(upper(statement), '^\\s*([0-9]{2})\\s+([A-Z][A-Z0-9-]+)\\b', 2) AS field, nullif(regexp_extract(upper(statement), '^\\s*([A-Z][A-Z0-9-]{1,30})\\.\\s*$', 1), '') AS name FROM y2),
y4 AS (SELECT *, last_value(h IGNORE NULLS) OVER w AS division, last_value(sec IGNORE NULLS) OVER w AS section, last_value(CASE WHEN lv = '01' THEN field END IGNORE NULLS) OVER w AS rec FROM y3 WINDOW w AS (PARTITION BY file ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""
_SITES = f"""{_EDGES}, {_DIVIDED},
lb AS (SELECT DISTINCT program, name AS paragraph FROM y4 JOIN prog USING (file) WHERE division = 'PROCEDURE' AND h IS NULL AND name IS NOT NULL AND name NOT IN ({_DATA_WORDS})),
q0 AS (SELECT program, line, statement, trim(u) AS u, name, coalesce(last_value(CASE WHEN name NOT IN ({_DATA_WORDS}) THEN name END IGNORE NULLS) OVER (PARTITION BY y4.file ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'TOP') AS paragraph FROM y4 JOIN prog USING (file) WHERE division = 'PROCEDURE' AND h IS NULL),
q1 AS (SELECT * EXCLUDE (name), split_part(u, ' ', 1) AS verb, substr(u, length(split_part(u, ' ', 1)) + 1) AS rest, contains(u, ' TO ') AS has_to FROM q0 WHERE name IS NULL),
dc AS (SELECT program, field AS variable, arg_min(CASE WHEN starts_with(field, 'DFH') THEN 'CICS_CONST' WHEN starts_with(field, 'EIB') THEN 'CICS_EIB' WHEN section = 'LINKAGE' AND rec IN ('DFHCOMMAREA', 'COMMAREA', 'LK-COMMAREA') THEN 'COMMAREA' ELSE coalesce(section, 'UNKNOWN') END, line) AS origin FROM y4 JOIN prog USING (file) WHERE division = 'DATA' AND field <> '' GROUP BY ALL),
nm AS (SELECT DISTINCT program, unnest({_ids('statement')}) AS variable FROM q1 UNION SELECT program, variable FROM dc),
vars AS (SELECT n.program, n.variable, coalesce(nullif(d.origin, 'UNKNOWN'), CASE WHEN starts_with(n.variable, 'TWCOB-') THEN 'COMMAREA' WHEN starts_with(n.variable, 'DFH') THEN 'CICS_CONST' WHEN starts_with(n.variable, 'EIB') THEN 'CICS_EIB' ELSE 'UNKNOWN' END) AS origin
 FROM nm n LEFT JOIN dc d ON d.program = n.program AND d.variable = n.variable WHERE {_IS_DATA.format('n.variable')} AND NOT EXISTS (SELECT 1 FROM lb WHERE lb.program = n.program AND lb.paragraph = n.variable)),
q2 AS (SELECT *, CASE WHEN verb = 'MOVE' AND has_to THEN {_ids(_after('rest', ' TO '))} WHEN verb = 'COMPUTE' THEN {_ids('rest')}[1:1] WHEN verb IN ('ADD', 'SUBTRACT', 'MULTIPLY', 'DIVIDE') THEN CASE WHEN has_to THEN {_ids(_after('rest', ' TO '))} WHEN contains(u, ' GIVING ') THEN {_ids(_after('u', ' GIVING '))} ELSE [] END
 WHEN verb = 'SET' THEN CASE WHEN has_to THEN {_ids("split_part(rest, ' TO ', 1)")} WHEN contains(u, ' UP BY ') THEN {_ids("split_part(rest, ' UP BY ', 1)")} ELSE [] END WHEN verb = 'INITIALIZE' THEN {_ids('rest')} WHEN verb = 'EXEC' AND contains(u, ' RECEIVE ') AND contains(u, ' INTO ') THEN {_ids(_after('u', ' INTO '))} ELSE [] END AS w,
 CASE WHEN verb IN ('GO', 'GOTO', 'GO-TO', 'INITIALIZE') THEN [] WHEN verb = 'PERFORM' THEN CASE WHEN contains(u, ' VARYING ') THEN {_ids('u')} ELSE [] END WHEN verb = 'MOVE' THEN CASE WHEN has_to THEN {_ids("split_part(rest, ' TO ', 1)")} ELSE [] END
 WHEN verb = 'COMPUTE' THEN CASE WHEN contains(u, '=') THEN {_ids(_after('u', '='))} ELSE {_ids('rest')}[2:] END WHEN verb IN ('ADD', 'SUBTRACT', 'MULTIPLY', 'DIVIDE') THEN {_ids('rest')} WHEN verb = 'SET' THEN CASE WHEN has_to THEN {_ids(_after('rest', ' TO '))} WHEN contains(u, ' UP BY ') THEN {_ids('rest')} ELSE [] END
 WHEN verb IN ('CALL', 'LINK', 'XCTL') THEN CASE WHEN contains(u, ' USING ') THEN {_ids(_after('u', ' USING '))} ELSE [] END ELSE {_ids('u')} END AS r, CASE WHEN regexp_matches(u, '^(IF|EVALUATE|WHEN) ') THEN {_ids('u')} ELSE [] END AS c FROM q1 WHERE paragraph NOT IN ({_in(sorted(fixed.DATAFLOW_WORDS))})),
q3 AS (SELECT program, unnest(w) AS variable, 'write' AS kind, paragraph, line, trim(statement) AS statement, [] AS targets FROM q2 UNION ALL SELECT program, unnest(list_filter(r, lambda x: NOT list_contains(w, x))), 'read', paragraph, line, trim(statement), [] FROM q2
 UNION ALL SELECT program, unnest(c), 'control', paragraph, line, trim(statement), list_filter(regexp_extract_all(u, '\\b(PERFORM|GO-TO|GOTO|CALL|LINK|XCTL)\\s+([A-Z][A-Z0-9-]+)\\b', 2), lambda t: t NOT IN ({_DATA_WORDS})) FROM q2
 UNION ALL SELECT program, unnest({_ids('condition')}), 'control', src, -1, condition, [dst] FROM rich WHERE condition <> ''),
sites AS (SELECT q.program, q.variable, kind, paragraph, CAST(line AS INTEGER) AS line, statement, list_sort(list_distinct(flatten(list(targets)))) AS targets FROM q3 q JOIN vars v ON v.program = q.program AND v.variable = q.variable GROUP BY ALL)"""
SQL["var_read_write"] = f"WITH {_SITES} SELECT program, variable, kind, paragraph, line, statement, array_to_string(targets, ',') AS targets FROM sites"
SQL["used_variables"] = f"WITH {_SITES} SELECT program, variable, origin FROM vars WHERE (program, variable) IN (SELECT (program, variable) FROM sites)"
SQL["first_site_lines"] = f"WITH {_SITES} SELECT program, variable, line FROM (SELECT *, row_number() OVER (PARTITION BY program, variable ORDER BY CASE kind WHEN 'write' THEN 1 WHEN 'read' THEN 2 ELSE 3 END, line) AS n FROM sites WHERE line > 0) WHERE n = 1"
_RECORDS = f"""SELECT v.program, v.variable, v.origin, coalesce(arg_min(s.paragraph, s.line) FILTER (kind = 'write'), '') AS defined_in, coalesce(string_agg(DISTINCT s.paragraph, ',' ORDER BY s.paragraph) FILTER (kind = 'write'), '') AS modified_in, coalesce(string_agg(DISTINCT s.paragraph, ',' ORDER BY s.paragraph) FILTER (kind = 'read'), '') AS used_in,
 coalesce(array_to_string(list_sort(list_distinct(list_filter(flatten(list(s.targets) FILTER (kind = 'control')), lambda t: t NOT IN ({_DATA_WORDS}, 'TOP')))), ','), '') AS fanout_nodes, coalesce(bool_or(kind = 'control'), FALSE) AS controls_flow FROM vars v LEFT JOIN sites s ON s.program = v.program AND s.variable = v.variable GROUP BY ALL"""
SQL["variable_records"] = f"WITH {_SITES} {_RECORDS}"
_MOVED = """(?i)\\bMOVE\\s+(''[^'']*''|"[^"]*"|[+-]?[0-9]+(?:\\.[0-9]+)?)\\s+TO\\s+([A-Z0-9-]+)\\b"""
SQL["literal_assignments"] = f"""WITH {_SITES}, rec AS ({_RECORDS}) SELECT DISTINCT s.program, s.variable AS target_variable, {_bare(f"regexp_extract(statement, '{_MOVED}', 1)")} AS literal, regexp_extract(statement, '{_MOVED}', 1) AS literal_raw, paragraph, nullif(line, 0) AS line, statement, r.origin, r.controls_flow,
 starts_with(upper(coalesce(r.origin, '')), 'COPY:PDCBVCM') OR regexp_matches(s.variable, '^M[0-9][A-Z0-9-]+[A-Z]$') AS screen_or_map_field, {' OR '.join(f"starts_with(s.variable, '{p}')" for p in fixed.COMMAREA_PREFIXES)} AS call_commarea_field
 FROM sites s JOIN rec r ON r.program = s.program AND r.variable = s.variable WHERE kind = 'write' AND upper(regexp_extract(statement, '{_MOVED}', 2)) = s.variable"""
SQL["screen_lineage"] = f"""WITH {_SITES}, own AS (SELECT program, variable, CASE WHEN length(variable) > 1 AND regexp_matches(variable, '[AFILO]$') THEN left(variable, length(variable) - 1) ELSE variable END AS family FROM vars WHERE starts_with(variable, 'CUST-'))
SELECT o.program, family, string_agg(DISTINCT o.variable, ',' ORDER BY o.variable) AS members, count(*) FILTER (kind = 'write') AS n_writes, count(*) FILTER (kind = 'read') AS n_reads, count(*) FILTER (kind = 'control') AS n_controls, min(CASE WHEN line > 0 THEN line END) AS first_line FROM own o LEFT JOIN sites s ON s.program = o.program AND s.variable = o.variable GROUP BY ALL"""

# --- screens, copybooks, packages -----------------------------------------------------------------------

_BLOCKS = f"""{sql('fx_cobol')}, prog AS (SELECT file, upper(regexp_extract(string_agg(raw, chr(10) ORDER BY line_no), '(?i)PROGRAM-ID\\.\\s*([A-Z0-9-]+)\\.', 1)) AS program FROM fx_cobol GROUP BY file),
m0 AS (SELECT file, line_no, substr(rpad(raw, 80, ' '), 7, 1) AS ind, rtrim(substr(rpad(raw, 80, ' '), 8, 65)) AS code FROM fx_cobol),
m1 AS (SELECT *, coalesce(sum(CASE WHEN contains(upper(code), 'END-EXEC') THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS part FROM m0 WHERE ind NOT IN ('*', '/') AND code <> ''),
m2 AS (SELECT *, min(CASE WHEN contains(upper(code), 'EXEC CICS') THEN line_no END) OVER (PARTITION BY file, part) AS opens FROM m1),
blocks AS (SELECT file, min(line_no) AS line_start, string_agg(code, ' ' ORDER BY line_no) AS statement FROM m2 WHERE line_no >= opens GROUP BY file, part HAVING bool_or(contains(upper(code), 'END-EXEC')))"""
_WORD = "upper(regexp_extract(statement, '(?i){0}\\s*\\(\\s*[''\"]?([A-Z0-9-]+)[''\"]?\\s*\\)', 1))"
SQL["screen_maps"] = f"""WITH {_BLOCKS}, n AS (SELECT program, line_start, {_WORD.format('MAP')} AS map, {_WORD.format('MAPSET')} AS mapset, trim(statement) AS evidence, CASE WHEN contains(' ' || upper(statement) || ' ', ' SEND ') THEN 'SEND' ELSE 'RECEIVE' END AS operation,
 list_filter(['CURSOR', 'DATAONLY', 'ERASE'], lambda o: contains(upper(statement), o)) AS options FROM blocks JOIN prog USING (file) WHERE regexp_matches(upper(statement), 'SEND|RECEIVE'))
SELECT program, map, mapset, string_agg(DISTINCT operation, ',' ORDER BY operation) AS operations, array_to_string(list_sort(list_distinct(flatten(list(options)))), ',') AS options, string_agg(evidence, ',' ORDER BY line_start, evidence) AS evidence FROM n WHERE map <> '' GROUP BY ALL"""

_BOOKS = f"""{sql('fx_facts')}, b0 AS (SELECT line_no, list_transform(regexp_extract_all(trim(raw) || ',', ' *("(?:[^"]|"")*"[^,]*|[^,]*),', 1), lambda x: trim(x, '"')) AS p FROM fx_facts WHERE trim(raw) <> ''),
b1_ AS (SELECT *, upper(trim(p[1])) AS rec, CASE WHEN upper(trim(p[1])) = 'FILE' THEN upper(regexp_replace(regexp_extract(p[3], '([^/\\\\]*)$', 1), '\\.[^.]*$', '')) END AS named FROM b0_),
bk AS (SELECT DISTINCT program, name FROM (SELECT coalesce(last_value(named IGNORE NULLS) OVER (ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'UNKNOWN') AS program, upper(p[len(p)]) AS name, rec FROM b1_) WHERE rec = 'COPY')""".replace("b0 AS (SELECT line_no, list_transform", "b0_ AS (SELECT line_no, list_transform")
SQL["unused_copybooks"] = f"""WITH {_SITES}, {_BOOKS}, v AS (SELECT program, variable, CASE WHEN starts_with(variable, 'CUST-') THEN 'COPY:PDCUST01' ELSE origin END AS origin FROM vars)
SELECT program, name FROM bk WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.program = bk.program AND (v.origin = 'COPY:' || bk.name OR v.variable = bk.name OR starts_with(v.variable, bk.name || '-')))"""
SQL["located_sources"] = """WITH n(name) AS (VALUES ('BILLRUN'), ('TWICE'), ('NONE')), f(file) AS (VALUES ('a/billrun.cbl'), ('a/TWICE.cbl'), ('b/twice.cbl')), m AS (SELECT name, count(file) AS n, min(file) AS file FROM n LEFT JOIN f ON upper(regexp_extract(file, '([^/]*)\\.[^.]*$', 1)) = name GROUP BY name)
SELECT name, CASE n WHEN 0 THEN 'MISSING' WHEN 1 THEN 'FOUND' ELSE 'AMBIGUOUS' END AS status, CASE WHEN n = 1 THEN file END AS file FROM m"""
SQL["package_manifest"] = f"""WITH {sql('fx_cobol')}, {sql('fx_jcl')}, prog AS (SELECT file, upper(regexp_extract(string_agg(raw, chr(10) ORDER BY line_no), '(?i)PROGRAM-ID\\.\\s*([A-Z0-9-]+)\\.', 1)) AS program FROM fx_cobol GROUP BY file),
refs AS (SELECT DISTINCT file, upper(regexp_extract(raw, '(?i)^\\s*(?:[A-Z0-9-]+\\s+)?COPY\\s+[''"]?([A-Z0-9_-]+)', 1)) AS book FROM fx_cobol), books(stem, file) AS (VALUES ('PDRUTI01', 'cpy/PDRUTI01.cpy')), flows(stem, file) AS (VALUES ('BILLRUN', 'cfg/billrun.json'), ('OTHER', 'cfg/other.json')),
texts AS (SELECT file, upper(string_agg(raw, chr(10) ORDER BY line_no)) AS body FROM fx_jcl GROUP BY file)
SELECT program, p.file, coalesce((SELECT string_agg(b.file, ',' ORDER BY b.file) FROM refs r JOIN books b ON b.stem = r.book WHERE r.file = p.file), '') AS copybooks,
 coalesce((SELECT string_agg(r.book, ',' ORDER BY r.book) FROM refs r WHERE r.file = p.file AND r.book NOT IN ('', {_in(fixed.SYSTEM_COPYBOOKS)}) AND r.book NOT IN (SELECT stem FROM books)), '') AS missing_copybooks,
 coalesce((SELECT string_agg(t.file, ',' ORDER BY t.file) FROM texts t WHERE contains(t.body, p.program)), '') AS jobs, 'facts/result.txt' AS mapa, (SELECT file FROM flows WHERE stem = p.program) AS controlflow FROM prog p"""

_NOTE = f"{_OUT}(?:<==|[*][*])"
_VALUE = "trim(regexp_extract(x, '^[^=]*=(.*)$', 1))"
SQL["operand_functions"] = f"""WITH {sql('fx_texts')}, n AS (SELECT id, text AS t, regexp_matches(text, '{_NOTE}') AS noted, regexp_matches(text, '{_OUT}  ') AS more_ FROM fx_texts WHERE text IS NOT NULL),
c AS (SELECT id, rtrim(CASE WHEN noted THEN regexp_extract(t, '{_NOTE}(.*)$', 1) ELSE t END) AS body, CASE WHEN noted THEN {_collapse(f"regexp_extract(t, '{_NOTE}(.*)$', 2)")} ELSE '' END AS note,
 rtrim(CASE WHEN more_ THEN regexp_extract(t, '{_OUT}  ', 1) ELSE t END) AS cut, CASE WHEN more_ THEN {_collapse(f"regexp_extract(t, '{_OUT}(  .*)$', 2)")} ELSE '' END AS more FROM n),
i AS (SELECT *, list_filter(list_transform(regexp_extract_all(cut, '{_ITEM}', 1), lambda x: trim(x)), lambda x: x <> '') AS items FROM c),
k AS (SELECT *, list_transform(list_filter(items, lambda x: contains(x, '=')), lambda x: {{'k': upper(trim(split_part(x, '=', 1))), 'v': CASE WHEN regexp_matches({_VALUE}, '^''.*''$') THEN {_VALUE} ELSE trim(regexp_replace({_VALUE}, '\\s{{2,}}.*$', '')) END}}) AS kv FROM i)
SELECT id, body, note, cut, more, array_to_string(list_filter(items, lambda x: NOT contains(x, '=')), '|') AS positional, '{{' || array_to_string(list_transform(list_filter(kv, lambda p, j: len(list_filter(kv[j + 1:], lambda q: q.k = p.k)) = 0), lambda p: '"' || p.k || '":"' || p.v || '"'), ',') || '}}' AS keyword FROM k"""
