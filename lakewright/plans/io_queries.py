"""Queries of sources and sinks: what is written is read again, what is read is invented text; with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import sinks
from ..operators.checkpoint import use_checkpoint_dir
from ..session import table
from ..sources import documents, text

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(oracle: str):
    def add(fn):
        QUERIES[fn.__name__], SQL[fn.__name__] = fn, oracle
        return fn

    return add


def _folder(spark, name: str) -> str:
    """A new folder where every executor can write and read."""
    use_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


@query("SELECT * FROM nation")
def json_lines_round_trip(spark, sf_dir):
    """Rows written as JSON lines and read again."""
    rows, path = table(spark, sf_dir, "nation"), _folder(spark, "lines")
    sinks.json_lines(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query("SELECT * FROM region")
def pretty_json_round_trip(spark, sf_dir):
    """Rows written as indented objects, cut at the empty lines between them and parsed again."""
    rows, path = table(spark, sf_dir, "region"), _folder(spark, "pretty")
    sinks.pretty_json(rows, path)
    each = spark.read.text(path, wholetext=True).select(F.explode(F.split("value", r"\n\n")).alias("v")).where("trim(v) <> ''")
    return each.select(F.from_json("v", rows.schema).alias("r")).select("r.*")


@query("SELECT * FROM nation")
def entity_folders_round_trip(spark, sf_dir):
    """A folder for each region, read again with the region as a partition column."""
    rows, path = table(spark, sf_dir, "nation"), _folder(spark, "entities")
    sinks.by_entity(rows, path, "n_regionkey")
    return spark.read.schema(rows.schema).json(path).select(*rows.columns)


@query("""SELECT '# Regions' || chr(10) || chr(10) || '| r_regionkey | r_name |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || r_regionkey || ' | ' || r_name || ' |', chr(10) ORDER BY r_regionkey) || chr(10) AS report FROM region""")
def markdown_report(spark, sf_dir):
    rows = table(spark, sf_dir, "region").select("r_regionkey", "r_name").orderBy("r_regionkey")
    return spark.createDataFrame([(sinks.markdown(rows, "Regions"),)], "report string")


@query("""SELECT 'Orders' || chr(10) || '======' || chr(10) || chr(10) || 'orders    : ' || count(*) || chr(10) || 'customers : ' || count(DISTINCT o_custkey) || chr(10) AS report FROM orders""")
def scorecard_report(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("orders"), F.count_distinct("o_custkey").alias("customers"))
    return spark.createDataFrame([(sinks.scorecard(rows, "Orders"),)], "report string")


_BYTES = [(1, "plain"), (2, "perché"), (3, "è già"), (4, "")]
_HEX = ", ".join(f"({i}, '{(t.encode() if i != 3 else t.encode('latin-1')).hex()}')" for i, t in _BYTES)
_LATIN = "array_to_string(list_transform(generate_series(1, length(h) // 2), lambda i: chr(CAST('0x' || substr(h, CAST(2 * i - 1 AS BIGINT), 2) AS INTEGER))), '')"


@query(f"WITH b(id, h) AS (VALUES {_HEX}) SELECT id, coalesce(TRY(decode(unhex(h))), {_LATIN}) AS latin, coalesce(TRY(decode(unhex(h))), {_LATIN}) AS windows FROM b")
def decoded_bytes(spark, sf_dir):
    """Bytes that aren't UTF-8 read as Latin-1, or as Windows-1252 (the same for these)."""
    rows = spark.createDataFrame([(i, bytearray(t.encode() if i != 3 else t.encode("latin-1"))) for i, t in _BYTES], "id int, content binary")
    return rows.select("id", text.decoded(F.col("content"), "latin").alias("latin"), text.decoded(F.col("content"), "windows").alias("windows"))


_SUMMARY = ["Summary of calls", "Programs called:", "- TAXCALC", " - PRICER (twice)", "", "COPYBOOKS used", "- PDCUST01", "see BILLRUN.json and taxcalc.JSON, BILLRUN.json", "- ", "end"]
_LINES = ", ".join(f"('s.txt', {i}, '{t}')" for i, t in enumerate(_SUMMARY, 1))


def _summary(spark):
    return spark.createDataFrame([("s.txt", i, t) for i, t in enumerate(_SUMMARY, 1)], "file string, line_no int, raw string")


@query(f"""WITH l(file, line_no, raw) AS (VALUES {_LINES}), o AS (SELECT *, CASE WHEN starts_with(upper(trim(raw)), 'PROGRAMS') THEN 'programs' WHEN starts_with(upper(trim(raw)), 'COPYBOOKS') THEN 'copybooks' END AS opens FROM l),
s AS (SELECT *, last_value(opens IGNORE NULLS) OVER (ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM o)
SELECT file, section, line_no, regexp_extract(trim(raw), '^-\\s*(.+)$', 1) AS entry FROM s WHERE opens IS NULL AND section IS NOT NULL AND regexp_extract(trim(raw), '^-\\s*(.+)$', 1) <> ''""")
def summary_sections(spark, sf_dir):
    """Entries below the headers of a summary."""
    return text.summary_sections(_summary(spark), {"PROGRAMS": "programs", "COPYBOOKS": "copybooks"})


@query(f"WITH l(file, line_no, raw) AS (VALUES {_LINES}) SELECT DISTINCT upper(unnest(regexp_extract_all(raw, '(?i)([A-Z0-9_$#@-]+)\\.json', 1))) AS stem FROM l")
def report_stems(spark, sf_dir):
    """Names of the JSON files that a report mentions."""
    return text.report_stems(_summary(spark), "raw")


_IDS = [("a/one.cbl", 1, "       PROGRAM-ID. FIRST."), ("a/one.cbl", 2, "       PROGRAM-ID. LATER."), ("b/two.CBL", 1, "* no name"), ("c/three.cob", 4, "program-id.   x-3")]
_ID_ROWS = ", ".join(f"('{f}', {n}, '{t}')" for f, n, t in _IDS)
_STEM = "upper(regexp_replace(regexp_extract(file, '([^/]*)$', 1), '\\.[^.]*$', ''))"


@query(f"""WITH l(file, line_no, raw) AS (VALUES {_ID_ROWS}), n AS (SELECT file, line_no, nullif(upper(regexp_extract(raw, '(?i)PROGRAM-ID\\.\\s*([A-Z0-9-]+)', 1)), '') AS loose, nullif(upper(regexp_extract(raw, '(?i)PROGRAM-ID\\.\\s*([A-Z0-9-]+)\\.', 1)), '') AS strict FROM l)
SELECT file, coalesce(arg_min(loose, line_no) FILTER (loose IS NOT NULL), {_STEM}) AS loose, coalesce(arg_min(strict, line_no) FILTER (strict IS NOT NULL), {_STEM}) AS strict FROM n GROUP BY file""")
def program_ids(spark, sf_dir):
    """A program's name by the loose and by the strict pattern, else its file's stem."""
    rows = spark.createDataFrame(_IDS, "file string, line_no int, raw string")
    loose, strict = text.program_names(rows), text.program_names(rows, r"(?i)PROGRAM-ID\.\s*([A-Z0-9-]+)\.")
    return loose.select("file", F.col("program").alias("loose")).join(strict.select("file", F.col("program").alias("strict")), "file")


_JSON = [("many.json", '[{"a":1},2,{"b":"x"},null,[3]]'), ("one.json", '{"a":true}'), ("text.json", '"word"'), ("bad.json", '{"a":'), ("empty.json", "")]
_JSON_ROWS = ", ".join(f"('{f}', '{t}')" for f, t in _JSON)


def _json(spark):
    return spark.createDataFrame(_JSON, "file string, text string")


@query(f"""WITH f(file, text) AS (VALUES {_JSON_ROWS}), v AS (SELECT file, CAST(text AS JSON) AS j FROM f WHERE json_valid(text)), i AS (SELECT file, unnest(json_extract(j, '$[*]')) AS d, unnest(generate_series(1, CAST(json_array_length(j) AS BIGINT))) AS pos FROM v WHERE json_type(j) = 'ARRAY')
SELECT file, CAST(row_number() OVER (PARTITION BY file ORDER BY pos) - 1 AS INTEGER) AS json_index, CAST(d AS VARCHAR) AS doc FROM i WHERE json_type(d) = 'OBJECT' UNION ALL SELECT file, 0, CAST(j AS VARCHAR) FROM v WHERE json_type(j) = 'OBJECT'""")
def json_objects(spark, sf_dir):
    """The objects of each file, an array's or the one that it is; all else gives none."""
    return documents.json_documents(_json(spark)).withColumn("doc", F.to_json("doc"))


@query(f"WITH f(file, text) AS (VALUES {_JSON_ROWS}) SELECT file FROM f WHERE NOT json_valid(text)")
def invalid_json_files(spark, sf_dir):
    return documents.invalid_json(_json(spark))


_GRAPHS = [
    ("ok.json", '{"graph":{"name":"G"},"nodes":["A","B"],"edges":[{"from":"A","to":"B"}]}'), ("name.json", '{"graph":{},"nodes":["A"],"edges":[]}'),
    ("ends.json", '{"graph":{"name":"G"},"nodes":["A","A"],"edges":[{"from":"A"}]}'), ("far.json", '{"graph":{"name":"G"},"nodes":["A"],"edges":[{"from":"A","to":"Z"}]}'), ("bad.json", "{"),
]
_GRAPH_ROWS = ", ".join(f"('{f}', '{t}')" for f, t in _GRAPHS)


@query(f"""WITH f(file, text) AS (VALUES {_GRAPH_ROWS}), v AS (SELECT file, CASE WHEN json_valid(text) THEN CAST(text AS JSON) END AS j FROM f),
p AS (SELECT file, j, json_extract_string(j, '$.nodes[*]') AS nodes, json_extract_string(j, '$.edges[*].from') AS src, json_extract_string(j, '$.edges[*].to') AS dst, CAST(json_array_length(j, '$.edges') AS BIGINT) AS n FROM v)
SELECT file, array_to_string(list_filter([CASE WHEN j IS NULL THEN 'invalid_json' END, CASE WHEN j IS NOT NULL AND coalesce(json_extract_string(j, '$.graph.name'), '') = '' THEN 'missing_graph_name' END, CASE WHEN j IS NOT NULL AND (len(src) < n OR len(dst) < n) THEN 'edge_without_ends' END,
 CASE WHEN len(list_filter(list_concat(src, dst), lambda x: NOT list_contains(nodes, x))) > 0 THEN 'edge_of_unknown_node' END, CASE WHEN len(list_distinct(nodes)) < len(nodes) THEN 'duplicate_nodes' END], lambda x: x IS NOT NULL), ',') AS problems FROM p""")
def graph_json_problems(spark, sf_dir):
    """What is wrong with control-flow graphs' JSON."""
    rows = spark.createDataFrame(_GRAPHS, "file string, text string")
    return documents.graph_problems(rows).withColumn("problems", F.array_join("problems", ","))
