"""JSON documents, JSON lines and DOT graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def json_documents(files: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """file, json_index, doc (VARIANT): the objects of each file, an array's or the one that it is; anything else gives none."""
    parsed = files.select(F.col(file).alias("file"), F.try_parse_json(F.col(text)).alias("v")).where("v IS NOT NULL")
    kind = F.schema_of_variant("v")
    many = parsed.where(F.startswith(kind, F.lit("ARRAY"))).select("file", F.expr("try_variant_get(v, '$', 'array<variant>')").alias("items"))
    each = many.select("file", F.posexplode("items").alias("pos", "doc"))
    each = each.where(F.startswith(F.schema_of_variant("doc"), F.lit("OBJECT")))
    index = F.row_number().over(_window("file", "pos")) - 1
    single = parsed.where(F.startswith(kind, F.lit("OBJECT"))).select("file", F.lit(0).alias("json_index"), F.col("v").alias("doc"))
    return each.select("file", index.alias("json_index"), "doc").unionByName(single)


def _window(key: str, order: str):
    from pyspark.sql import Window

    return Window.partitionBy(key).orderBy(order)


def invalid_json(files: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """file of every text that isn't JSON."""
    return files.where(F.try_parse_json(F.col(text)).isNull()).select(F.col(file).alias("file"))


def json_lines(lines: DataFrame) -> DataFrame:
    """file, line_no, doc (VARIANT; null on a bad line) of the lines that aren't blank."""
    rows = lines.where(F.length(F.trim("raw")) > 0)
    return rows.select("file", "line_no", F.try_parse_json("raw").alias("doc"))


def dot_edges(files: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """file, edge_no, src, dst: the <A>-><B>; edges in order."""
    pattern = F.lit(r"<([^>]+)>\s*->\s*<([^>]+)>\s*;")
    src, dst = F.regexp_extract_all(F.col(text), pattern, 1), F.regexp_extract_all(F.col(text), pattern, 2)
    pairs = files.select(F.col(file).alias("file"), F.posexplode(F.arrays_zip(src.alias("src"), dst.alias("dst"))).alias("edge_no", "edge"))
    return pairs.select("file", (F.col("edge_no") + 1).alias("edge_no"), F.trim("edge.src").alias("src"), F.trim("edge.dst").alias("dst"))


def dot_graphs(files: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """file, name, rankdir, problem: null if it is a graph, else missing_digraph or no_edges."""
    t = F.col(text)
    name = F.nullif(F.regexp_extract(t, r"(?i)digraph\s+([A-Za-z0-9_-]+)\s*\{", 1), F.lit(""))
    rankdir = F.nullif(F.regexp_extract(t, r"(?i)rankdir\s*=\s*([A-Z]{2})", 1), F.lit(""))
    problem = F.when(name.isNull(), "missing_digraph").when(~t.rlike(r"<[^>]+>\s*->\s*<[^>]+>\s*;"), "no_edges")
    return files.select(F.col(file).alias("file"), name.alias("name"), F.coalesce(rankdir, F.lit("LR")).alias("rankdir"), problem.alias("problem"))


def graph_problems(files: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """file, problems: what is wrong with a control-flow graph's JSON; an empty array if nothing."""
    v = F.try_parse_json(F.col(text))
    of = lambda path, kind: F.expr(f"try_variant_get(v, '{path}', '{kind}')")
    rows = files.select(F.col(file).alias("file"), v.alias("v"))
    nodes, edges = of("$.nodes", "array<string>"), F.expr("try_variant_get(v, '$.edges', 'array<variant>')")
    ends = lambda e, k: F.expr(f"try_variant_get({e}, '$.{k}', 'string')")
    rows = rows.select("file", "v", of("$.graph.name", "string").alias("name"), nodes.alias("nodes"), edges.alias("edges"))
    rows = rows.withColumn("src", F.expr("transform(edges, e -> try_variant_get(e, '$.from', 'string'))")).withColumn("dst", F.expr("transform(edges, e -> try_variant_get(e, '$.to', 'string'))"))
    known = lambda side: F.forall(side, lambda x: F.array_contains("nodes", x))
    problems = F.array_compact(
        F.array(
            F.when(F.col("v").isNull(), "invalid_json"),
            F.when(F.col("v").isNotNull() & F.coalesce(F.col("name"), F.lit("")).eqNullSafe(""), "missing_graph_name"),
            F.when(F.col("v").isNotNull() & F.col("nodes").isNull(), "nodes_not_strings"),
            F.when(F.col("v").isNotNull() & F.col("edges").isNull(), "edges_not_list"),
            F.when(F.exists("src", lambda x: x.isNull()) | F.exists("dst", lambda x: x.isNull()), "edge_without_ends"),
            F.when(~known("src") | ~known("dst"), "edge_of_unknown_node"),
            F.when(F.size(F.array_distinct("nodes")) < F.size("nodes"), "duplicate_nodes"),
        )
    )
    return rows.select("file", problems.alias("problems"))
