"""Whole-program and whole-corpus plans: one DAG from sources to documents, keyed by program."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import comments, dataflow, documents, graph, index, jobs, maps, rules
from ..operators.checkpoint import checkpointed
from ..sources import cobol, facts
from ..sources.text import program_names


Keep = Callable[[DataFrame], DataFrame]


def program_relations(lines: DataFrame, copybook_lines: DataFrame | None = None, edges: DataFrame | None = None, overrides: DataFrame | None = None, keep: Keep = checkpointed) -> dict[str, DataFrame]:
    """Graph, rules, data flow, comments and calls of all programs at once.

    edges(program, edge_no, src, dst) of a given control-flow graph; without them they are extracted from the text.
    ``keep`` is applied to what several relations are built from, which would else be computed for each of them.
    """
    programs = keep(program_names(lines))
    nodes, own = graph.extract(lines, keep=keep)
    nodes = keep(nodes)
    edges = own if edges is None else edges
    order = cobol.raw_paragraph_order(lines, programs).join(programs, "file").select("program", "paragraph", "ord")
    rich = keep(graph.enriched(edges, cobol.raw_paragraph_lines(lines, programs), order, overrides))
    flow = dataflow.program_dataflow(lines, programs, copybook_lines, rich)
    flow |= {"variables": keep(flow["variables"]), "sites": keep(flow["sites"])}
    rule = rules.rules(rich)
    told = keep(comments.classified(cobol.comments(lines)).join(programs, "file"))
    called = keep(dataflow.outgoing_calls(cobol.terminated_statements(lines)).join(programs, "file"))
    return flow | {"programs": programs, "nodes": nodes, "edges": rich, "rules": rule, "comments": told, "calls": called}


def program_documents(r: dict[str, DataFrame], recs: DataFrame | None = None) -> DataFrame:
    """Documents of programs' rules, comments and records."""
    out = rules.detail_documents(r["rules"]).unionByName(comments.comment_documents(r["comments"].where("indexable"), comments.links(r["rules"], r["sites"])))
    return out if recs is None else out.unionByName(documents.fact_documents(recs))


def corpus_documents(recs: DataFrame, r: dict[str, DataFrame]) -> DataFrame:
    """Documents of the maps across programs."""
    books = maps.copybook_map(facts.copybooks(recs))
    edges = maps.call_edges(facts.calls(recs), recs.select("program").distinct())
    variables = maps.variable_map(r["variables"], r["sites"])
    control = r["sites"].where("kind = 'control'").select("program", "variable")
    return maps.global_documents(books, edges, maps.table_map(facts.tables(recs)), variables, maps.structures(r["variables"], control))


def index_records(docs: DataFrame, source_file: str = "artifacts/documents.json") -> DataFrame:
    """Index records of documents; a document's number is its place among its program's by id."""
    from pyspark.sql import Window

    number = F.row_number().over(Window.partitionBy("program").orderBy("id")) - 1
    rows = index.document_text(docs).withColumn("source_file", F.lit(source_file)).withColumn("json_index", number)
    return index.records(rows)


def job_relations(lines: DataFrame, keep: Keep = checkpointed) -> dict[str, DataFrame]:
    return jobs.analyse(lines, keep)
