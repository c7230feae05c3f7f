"""Rules from conditioned edges, and their documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import rule_category, rule_flags, rule_kind, rule_severity
from ..functions.ids import short_blake
from ..functions.text import ascii_arrows, collapse
from .documents import document


def rules(edges: DataFrame) -> DataFrame:
    """program, id, scope, category, kind, severity, condition, action, flags, evidence columns, of edges with a condition.

    Technical rules are dropped before the rest are numbered in edge order.
    """
    rows = edges.where("condition <> ''").withColumn("category", rule_category(F.col("dst"), F.col("type"))).withColumn("condition", collapse(F.col("condition")))
    rows = rows.withColumn("kind", rule_kind(F.col("category"), F.col("condition"))).where("kind <> 'technical'")
    number = F.row_number().over(Window.partitionBy("program").orderBy("edge_no"))
    return rows.select(
        "program", F.format_string("BR-%03d", number).alias("id"), F.col("src").alias("scope"), "category", "kind", rule_severity(F.col("category")).alias("severity"), "condition",
        F.concat_ws(" -> ", "type", "dst").alias("action"), rule_flags(F.col("condition")).alias("flags"), "src", "dst", "type", "evidence",
    )


def _told(category: Column) -> Column:
    """The sentence of a rule by its category."""
    say = lambda text: F.format_string(text, "condition", "scope")
    return (
        F.when(category == "error", say("The program terminates with an error when the condition '%s' is met in paragraph %s."))
        .when(category == "permission", say("The operation is blocked when the condition '%s' is satisfied in paragraph %s."))
        .when(category == "precondition", say("The operation is allowed only when the condition '%s' is true in paragraph %s."))
        .when(category == "validation", say("The program validates that '%s' holds before continuing in paragraph %s."))
        .otherwise(say("A business rule applies when the condition '%s' is evaluated in paragraph %s."))
    )


def business_documents(rules_: DataFrame) -> DataFrame:
    """Documents of the rules of kind business only, told in a sentence."""
    own = rules_.where("kind = 'business'")
    content = F.struct("category", "severity", "condition", "action", "scope")
    return document(own, F.concat(F.lit("RAG-"), "id"), F.lit("business_rule"), F.col("program"), F.lit(None).cast("string"), _told(F.col("category")), content, F.struct(F.col("id").alias("source_rule_id"), "flags"))


def detail_documents(rules_: DataFrame, program: str | None = None) -> DataFrame:
    """One document a rule. For a program: all rules if any is of it by program or scope, else only those that name it."""
    rows = rules_
    if program is not None:
        mine = (F.upper("program") == program.upper()) | (F.upper("scope") == program.upper())
        some = rules_.where(mine).limit(1).count() > 0
        rows = rows if some else rows.where(mine | (F.coalesce("program", F.lit("")) == ""))
        rows = rows.withColumn("program", F.lit(program.upper()))
    rows = rows.withColumn("action", ascii_arrows(F.col("action")))
    text = F.format_string("%s business rule %s in scope %s. If %s then %s. Category=%s. Kind=%s. Severity=%s.", "program", "id", "scope", "condition", "action", "category", "kind", "severity")
    content = F.struct("id", "program", "scope", "category", "kind", "severity", "condition", "action", "flags", F.struct(F.col("src").alias("from"), F.col("dst").alias("to"), "type", F.col("evidence").alias("raw_evidence")).alias("evidence"))
    meta = F.struct(F.lit("rules").alias("source"), "scope", "category", "kind", "severity", F.size("flags").alias("flags_count"))
    return document(rows, short_blake(F.concat_ws("|", "program", "id", "scope")), F.lit("business_rule"), F.col("program"), F.format_string("%s rule %s", "program", "id"), text, content, meta)
