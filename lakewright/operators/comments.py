"""Comments of programs: classified, linked to rules and variables, measured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.classify import bare_comment, comment_reason, is_indexable, with_comment_class
from ..functions.ids import comment_id
from ..sources import cobol
from .documents import document
from .relational import ratio


def classified(comments: DataFrame) -> DataFrame:
    """comments with normalized_text, classification, classification_reason and indexable."""
    rows = with_comment_class(comments, "text").withColumn("normalized_text", bare_comment(F.col("text")))
    rows = rows.withColumn("classification_reason", comment_reason(F.col("classification"), F.col("kind"), F.col("in_procedure")))
    return rows.withColumn("indexable", is_indexable(F.col("classification")))


def metrics(lines: DataFrame, comments: DataFrame) -> DataFrame:
    """One row a file: lines, procedure paragraphs, coverage, comments per 100 lines, orphans, counts by class."""
    labels = cobol.procedure_statements(cobol.statements(lines), toggles=False)
    name = F.nullif(F.regexp_extract(F.upper("statement"), fixed.PARAGRAPH, 1), F.lit(""))
    paragraphs = labels.groupBy("file").agg(F.count_distinct(name).alias("total_procedure_paragraphs"))
    total = lines.groupBy("file").agg(F.max("line_no").alias("total_lines"))
    good = F.col("indexable")
    seen = comments.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_comments"), F.count_if(good).alias("n_indexable"), F.count_if(F.col("paragraph").isNull()).alias("orphan_comments"),
        F.count_distinct("paragraph").alias("paragraphs_with_comments"), F.count_distinct(F.when(good, F.col("paragraph"))).alias("paragraphs_with_indexable_comments"),
        *[F.count_if(F.col("classification") == c).alias(f"n_{c}") for c in ("commented_out_code", "section_header", "name_or_reference", "descriptive_header", "explanatory_comment")],
    )
    out = total.join(paragraphs, "file", "left").join(seen, "file", "left").na.fill(0)
    share = lambda a, b: F.round(F.when(F.col(b) == 0, 0.0).otherwise(ratio(F.col(a), F.col(b)) * 100), 2)
    return (
        out.withColumn("paragraph_coverage_pct", share("paragraphs_with_comments", "total_procedure_paragraphs"))
        .withColumn("indexable_paragraph_coverage_pct", share("paragraphs_with_indexable_comments", "total_procedure_paragraphs"))
        .withColumn("comments_per_100_lines", share("n_comments", "total_lines"))
        .withColumn("indexable_comments_per_100_lines", share("n_indexable", "total_lines"))
    )


def links(rules: DataFrame, sites: DataFrame) -> DataFrame:
    """program, paragraph, business_rules, variables: inverted indexes of the paragraphs that rules and sites name."""
    of_rules = rules.select("program", F.explode(F.array_distinct(F.array(F.upper("scope"), F.upper("src")))).alias("paragraph"), F.col("id").alias("x"))
    of_rules = of_rules.groupBy("program", "paragraph").agg(F.array_sort(F.collect_set("x")).alias("business_rules"))
    of_vars = sites.groupBy("program", F.upper("paragraph").alias("paragraph")).agg(F.array_sort(F.collect_set("variable")).alias("variables"))
    return of_rules.join(of_vars, ["program", "paragraph"], "full_outer")


def comment_documents(comments: DataFrame, links_: DataFrame) -> DataFrame:
    """One document a comment. comments carry program; links come from links()."""
    empty = F.array().cast("array<string>")
    rows = comments.join(links_, ["program", "paragraph"], "left")
    rows = rows.withColumn("business_rules", F.transform(F.coalesce("business_rules", empty), lambda r: F.concat(F.lit("business_rule."), r, F.lit(".json")))).withColumn("variables", F.coalesce("variables", empty))
    place = F.concat_ws("", F.concat(F.lit(" section "), "section"), F.concat(F.lit(" paragraph "), "paragraph"))
    title = F.format_string("%s comment line %d", "program", "line_no")
    tag = lambda name, c: F.concat(F.lit(f"{name}:"), c)
    tags = F.array_compact(F.array(tag("program", F.col("program")), tag("kind", F.col("kind")), tag("classification", F.col("classification")), tag("section", F.col("section")), tag("paragraph", F.col("paragraph")), F.when(F.col("indexable"), "indexable:true")))
    content = F.struct(F.col("line_no").alias("line"), "section", "paragraph", "kind", "text", "text_raw", "normalized_text", "classification", "classification_reason", "indexable")
    meta = F.struct(F.col("file").alias("source"), F.col("line_no").alias("line"), "section", "paragraph", "kind", "classification", "indexable", tags.alias("tags"), F.struct("business_rules", "variables").alias("links"))
    return document(rows, comment_id(F.col("program"), F.col("line_no"), F.col("kind"), F.col("text")), F.lit("program.comment"), F.col("program"), title, F.concat(title, place, F.lit(". "), "text"), content, meta)


def disabled_code(comments: DataFrame) -> DataFrame:
    """The comments that look like disabled code."""
    return comments.where("classification = 'commented_out_code'")
