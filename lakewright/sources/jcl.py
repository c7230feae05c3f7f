"""Job scripts: statements, comments, and the steps, data definitions, procedures and symbols they declare."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.classify import is_decorative, is_warning
from ..functions.text import collapse, continuation_note, inline_note, operands, path_stem, strip, top_level_items, upper_name_or_null


def job_comments(lines: DataFrame) -> DataFrame:
    """file, line_no, text, decorative, warning of the //* lines."""
    text = strip(F.regexp_replace(strip(F.expr("substring(raw, 4)")), "^/+", ""))
    text = collapse(F.regexp_replace(text, r"\|+$", ""))
    rows = lines.where(F.startswith("raw", F.lit("//*"))).select("file", "line_no", text.alias("text"))
    return rows.withColumn("decorative", is_decorative(F.col("text"))).withColumn("warning", is_warning(F.col("text")))


def job_statements(lines: DataFrame) -> DataFrame:
    """file, seq, label, operation, operands, text, notes, start_line, end_line, implicit_label.

    Notes are cut off by expressions before the fold. Whether a line continues a statement depends on what that
    statement is by then, so a file's lines are folded in order (Arrow, one file at a time).
    """
    body = F.expr("substring(raw, 3)")
    free = F.substring(body, 1, 1).rlike(r"^\s$")
    rows = lines.where(F.startswith("raw", F.lit("//")) & ~F.startswith("raw", F.lit("//*"))).withColumn("raw", F.rtrim("raw"))
    rows = rows.withColumn("label", F.upper(strip(F.substring(body, 1, 8)))).withColumn("free", free)
    text, note1 = inline_note(strip(F.when(free, body).otherwise(F.expr("substring(raw, 11)"))))
    text, note2 = continuation_note(text)
    rows = rows.select("file", "line_no", "label", "free", text.alias("text"), F.filter(F.array(note1, note2), lambda x: x != "").alias("notes"))

    def fold(own: pd.DataFrame) -> pd.DataFrame:
        out: list[dict] = []
        first = lambda t: t.split(None, 1)[0].upper() if t.strip() else ""
        for row in own.sort_values("line_no").itertuples(index=False):
            now = out[-1] if out else None
            notes = list(row.notes)
            begins = now is None or not row.free and row.label != ""
            if now is not None and not begins:
                word = first(row.text)
                again = word == "DD" and first(now["text"]) == "DD"  # one more of the same name
                if not again and word not in fixed.CONTROL_OPERATIONS:
                    now["text"] = f"{now['text']} {row.text}".strip()
                    now["notes"] += notes
                    now["end_line"] = row.line_no
                    continue
                label, implicit = (now["label"], True) if again else ("", False)
            else:
                if now is None and row.free:
                    label = ""
                else:
                    label = row.label
                implicit = False
            out.append({"label": label, "text": row.text, "notes": notes, "start_line": row.line_no, "end_line": row.line_no, "implicit_label": implicit})
        for i, s in enumerate(out):
            words = s["text"].split(None, 1)
            s |= {"file": own["file"].iloc[0], "seq": i + 1, "operation": words[0].upper() if words else "", "operands": words[1].strip() if len(words) > 1 else ""}
            s["notes"] = list(dict.fromkeys(n for n in s["notes"] if n))
        names = ["file", "seq", "label", "operation", "operands", "text", "notes", "start_line", "end_line", "implicit_label"]
        return pd.DataFrame(out, columns=names)

    schema = "file string, seq int, label string, operation string, operands string, text string, notes array<string>, start_line int, end_line int, implicit_label boolean"
    return rows.groupBy("file").applyInPandas(fold, schema)


def with_context(stmts: DataFrame) -> DataFrame:
    """stmts with job (the last JOB's label, else the file's stem), in_proc and step_seq (its step's seq, for EXEC and DD).

    A step is open from its EXEC up to the first statement that is no DD; a procedure from PROC to PEND.
    """
    order = Window.partitionBy("file").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    op = F.col("operation")
    whole = Window.partitionBy("file").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    job = F.last(F.when((op == "JOB") & (F.col("label") != ""), F.col("label")), ignorenulls=True).over(whole)
    name = F.coalesce(F.nullif(F.col("label"), F.lit("")), upper_name_or_null(F.col("operands")), F.lit("PROC"))
    proc = F.last(F.when(op == "PROC", name).when(op == "PEND", F.lit("")), ignorenulls=True).over(order)
    step = F.last(F.when(op == "EXEC", F.col("seq")).when(op != "DD", F.lit(-1)), ignorenulls=True).over(order)
    return (
        stmts.withColumn("job", F.coalesce(job, F.upper(path_stem(F.col("file")))))
        .withColumn("in_proc", F.nullif(proc, F.lit("")))
        .withColumn("step_seq", F.nullif(step, F.lit(-1)))
    )


def steps(stmts: DataFrame) -> DataFrame:
    """file, job, seq, step, scope, defined_in_proc, exec_kind, target, program, proc, parameters, notes, start_line, end_line, resolved_locally."""
    positional, keyword = operands(F.col("operands"))
    own = with_context(stmts)
    rows = own.where("operation = 'EXEC'").withColumn("keyword", keyword).withColumn("positional", positional)
    program = upper_name_or_null(F.try_element_at("keyword", F.lit("PGM")))
    proc = F.coalesce(upper_name_or_null(F.try_element_at("keyword", F.lit("PROC"))), F.when(program.isNull(), upper_name_or_null(F.get("positional", F.lit(0)))))
    rows = rows.select(
        "file", "job", "seq", F.col("label").alias("step"), F.when(F.col("in_proc").isNull(), "job").otherwise("procedure_definition").alias("scope"),
        F.col("in_proc").alias("defined_in_proc"), program.alias("program"), proc.alias("proc"),
        F.map_filter("keyword", lambda k, v: ~k.isin("PGM", "PROC")).alias("parameters"), "notes", "start_line", "end_line",
    )
    local = procedures(stmts).select("file", F.col("procedure").alias("proc"), F.lit(True).alias("here"))
    kind = F.when(F.col("program").isNotNull(), "program").when(F.col("proc").isNotNull(), "procedure").otherwise("unknown")
    return rows.join(local, ["file", "proc"], "left").select(
        "file", "job", "seq", "step", "scope", "defined_in_proc", kind.alias("exec_kind"), F.coalesce("program", "proc").alias("target"), "program", "proc",
        "parameters", "notes", "start_line", "end_line", F.coalesce("here", F.lit(False)).alias("resolved_locally"),
    )


def definitions(stmts: DataFrame) -> DataFrame:
    """file, job, step_seq, dd_ordinal, ddname, concatenated, dsn, disp, sysout, unit, output, raw, notes of the DDs of steps."""
    _, keyword = operands(F.col("operands"))
    rows = with_context(stmts).where("operation = 'DD' AND step_seq IS NOT NULL").withColumn("keyword", keyword)
    value = lambda k: F.try_element_at("keyword", F.lit(k)).alias(k.lower())
    ordinal = F.row_number().over(Window.partitionBy("file", "step_seq").orderBy("seq"))
    return rows.select(
        "file", "job", "step_seq", ordinal.alias("dd_ordinal"), F.col("label").alias("ddname"), F.col("implicit_label").alias("concatenated"),
        *map(value, ("DSN", "DISP", "SYSOUT", "UNIT", "OUTPUT")), F.col("text").alias("raw"), "notes", "start_line", "end_line",
    )


def procedures(stmts: DataFrame) -> DataFrame:
    """file, procedure, parameters, start_line, end_line; of equal names the last definition."""
    _, keyword = operands(F.col("operands"))
    own = with_context(stmts)
    last = own.where("operation = 'PROC'").select("file", "seq", F.col("in_proc").alias("procedure"), keyword.alias("parameters"), "start_line")
    ends = own.where("in_proc IS NOT NULL OR operation = 'PEND'").groupBy("file", F.col("in_proc").alias("procedure")).agg(F.max("end_line").alias("end_line"))
    kept = last.withColumn("nth", F.row_number().over(Window.partitionBy("file", "procedure").orderBy(F.desc("seq")))).where("nth = 1").drop("nth", "seq")
    return kept.join(ends, ["file", "procedure"], "left")


def control_statements(stmts: DataFrame) -> DataFrame:
    """file, seq, label, operation, operands, parameters (of SET), scope, defined_in_proc."""
    _, keyword = operands(F.col("operands"))
    rows = with_context(stmts).where(F.col("operation").isin(*fixed.CONTROL_OPERATIONS))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return rows.select(
        "file", "seq", "label", "operation", "operands", F.when(F.col("operation") == "SET", keyword).otherwise(none).alias("parameters"),
        F.when(F.col("in_proc").isNull(), "job").otherwise("procedure_definition").alias("scope"), F.col("in_proc").alias("defined_in_proc"),
    )


def symbols(stmts: DataFrame) -> DataFrame:
    """file, symbol, value: the last SET of each."""
    rows = control_statements(stmts).where("operation = 'SET'").select("file", "seq", F.explode("parameters").alias("symbol", "value"))
    return rows.groupBy("file", "symbol").agg(F.max_by("value", "seq").alias("value"))


def libraries(stmts: DataFrame) -> DataFrame:
    """file, library: the distinct libraries of JCLLIB ORDER."""
    _, keyword = operands(F.col("operands"))
    order = F.regexp_replace(F.try_element_at(keyword, F.lit("ORDER")), r"^\((.*)\)$", "$1")
    return stmts.where("operation = 'JCLLIB'").select("file", F.explode(top_level_items(order)).alias("library")).distinct()
