"""Job scripts: access types, execution order, dataset catalog and lineage, comments, warnings, validation."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.classify import comment_section, dataset_access, dataset_kind, is_disabled_job_line, is_warning, starts
from ..functions.text import path_stem, preview, safe_name
from ..sources import jcl
from .relational import preceding_block

ACCESS = {"read": "reads", "write": "writes", "delete": "deletes", "control": "controls", "unknown": "unknowns"}


def annotated(definitions: DataFrame, steps: DataFrame) -> DataFrame:
    """definitions with step columns, dataset_kind, is_temporary, access_type and access_reason."""
    own = steps.select("file", F.col("seq").alias("step_seq"), "step", "scope", "defined_in_proc", "program", "proc", "exec_kind")
    rows = definitions.join(own, ["file", "step_seq"])
    access = dataset_access(F.col("ddname"), F.col("disp"), F.col("sysout"), F.col("raw"), F.col("dsn"), F.col("program"))
    rows = rows.withColumn("a", access).withColumn("dataset_kind", dataset_kind(F.col("dsn")))
    return rows.select("*", (F.col("dataset_kind") == "temporary").alias("is_temporary"), "a.access_type", "a.access_reason").drop("a")


def step_datasets(annotated_: DataFrame) -> DataFrame:
    """file, step_seq and an ordered list of distinct datasets for each access, sysouts included."""
    has = F.coalesce(F.col("dsn") != "", F.lit(False))
    held = lambda mine, value: F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(mine, F.struct("dd_ordinal", value.alias("v"))))), lambda x: x["v"]))
    lists = [held(has & (F.col("access_type") == a), F.col("dsn")).alias(name) for a, name in ACCESS.items()]
    sysouts = held(F.col("access_type") == "sysout", F.coalesce(F.nullif("ddname", F.lit("")), F.lit("SYSOUT"))).alias("sysouts")
    return annotated_.groupBy("file", "step_seq").agg(*lists, sysouts)


def execution_steps(steps: DataFrame) -> DataFrame:
    """file, execution_order, seq (of the step whose statements run), step, execution_scope, invoked_by_step, invoked_proc.

    A step that calls a local procedure is replaced by that procedure's steps; those in a procedure's definition don't run by themselves.
    """
    outer = steps.where("scope = 'job'").select("file", F.col("seq").alias("outer_seq"), F.col("step").alias("outer_step"), "proc", "exec_kind", "resolved_locally")
    inner = steps.where("defined_in_proc IS NOT NULL").select("file", F.col("defined_in_proc").alias("proc"), F.col("seq").alias("inner_seq"), F.col("step").alias("inner_step"))
    called = (F.col("exec_kind") == "procedure") & F.col("resolved_locally")
    expanded = outer.where(called).join(inner, ["file", "proc"]).select("file", "outer_seq", F.col("inner_seq").alias("seq"), F.col("inner_step").alias("step"), F.lit("expanded_local_procedure").alias("execution_scope"), F.col("outer_step").alias("invoked_by_step"), F.col("proc").alias("invoked_proc"))
    none = F.lit(None).cast("string")
    direct = outer.where(~called).select("file", "outer_seq", F.col("outer_seq").alias("seq"), F.col("outer_step").alias("step"), F.lit("job").alias("execution_scope"), none.alias("invoked_by_step"), none.alias("invoked_proc"))
    order = F.row_number().over(Window.partitionBy("file").orderBy("outer_seq", "seq"))
    return direct.unionByName(expanded).withColumn("execution_order", order).drop("outer_seq")


def dataset_usage(executed: DataFrame, annotated_: DataFrame) -> DataFrame:
    """One row for each dataset that a step of the execution uses, in order of execution and definition."""
    dds = annotated_.where("dsn <> ''").withColumnRenamed("step_seq", "seq").drop("step")
    return executed.join(dds, ["file", "seq"])


def dataset_catalog(usage: DataFrame) -> DataFrame:
    """file, job, dsn, dataset_kind, external_input, steps by role in order, n_usages, first_write_order."""
    by = {"write": "produced_by", "read": "consumed_by", "control": "controlled_by", "delete": "deleted_by"}
    first_write = F.min(F.when(F.col("access_type") == "write", F.col("execution_order"))).over(Window.partitionBy("file", "dsn"))
    rows = usage.withColumn("first_write_order", first_write)
    early = F.col("access_type").isin("read", "control") & (F.col("first_write_order").isNull() | (F.col("execution_order") < F.col("first_write_order")))
    place = F.struct("execution_order", "dd_ordinal", "step")
    steps_of = lambda a: F.transform(F.array_sort(F.collect_list(F.when(F.col("access_type") == a, place))), lambda x: x["step"])
    return rows.groupBy("file", "job", "dsn").agg(
        F.min_by("dataset_kind", F.when(F.col("dataset_kind").isNotNull(), F.struct("execution_order", "dd_ordinal"))).alias("dataset_kind"), F.bool_or(early).alias("external_input"),
        *[steps_of(a).alias(name) for a, name in by.items()], F.count(F.lit(1)).alias("n_usages"), F.min("first_write_order").alias("first_write_order"),
    )


def dataset_flow(usage: DataFrame) -> DataFrame:
    """file, job, from_step, to_step, dsn, flow_type: a read or delete after the last write before it, once each."""
    over = Window.partitionBy("file", "dsn").orderBy("execution_order", "dd_ordinal").rowsBetween(Window.unboundedPreceding, -1)
    writer = F.last(F.when(F.col("access_type") == "write", F.col("step")), ignorenulls=True).over(over)
    rows = usage.withColumn("from_step", writer).where("access_type IN ('read', 'delete') AND from_step IS NOT NULL")
    kind = F.when(F.col("access_type") == "read", "produces_input_for").otherwise("deleted_after")
    return rows.select("file", "job", "from_step", F.col("step").alias("to_step"), "dsn", kind.alias("flow_type")).distinct()


def step_comments(steps: DataFrame, comments: DataFrame) -> DataFrame:
    """file, seq, comment_context: the block of comments right before each step."""
    told = comments.where(~F.col("decorative") & ~is_disabled_job_line(F.col("text"))).select("file", F.col("line_no").alias("start_line"), "text")
    near = preceding_block(steps, told, "file", "start_line")
    rows = near.join(told.withColumnRenamed("start_line", "note"), ["file", "note"])
    grouped = rows.groupBy("file", F.col("mark").alias("start_line")).agg(F.transform(F.array_sort(F.collect_list(F.struct("note", "text"))), lambda x: x["text"]).alias("comment_context"))
    return steps.select("file", "seq", "start_line").join(grouped, ["file", "start_line"]).drop("start_line")


def comment_sections(comments: DataFrame) -> DataFrame:
    """file, section, item_no, item: the bullets below section headers, with the lines that go on from them.

    A header opens, a changelog line closes; a line that is neither bullet nor continuation closes too, which depends on
    whether the section has a bullet yet: one aggregate over the ordered comments decides (a fold, JVM-side).
    """
    section = comment_section(F.col("text"))
    rows = comments.where(~F.col("decorative")).withColumn("opens", section).withColumn("changelog", starts(F.upper("text"), "MODIFICATO"))
    rows = rows.withColumn("bullet", starts(F.col("text"), "-")).withColumn("disabled", is_disabled_job_line(F.col("text")))

    def fold(own: pd.DataFrame) -> pd.DataFrame:
        out, now, held = [], None, {}
        for r in own.sort_values("line_no").itertuples(index=False):
            if r.changelog:
                now = None
            elif r.opens is not None:
                now = r.opens
            elif now is not None and r.bullet:
                if item := r.text.lstrip("- ").strip():
                    held[now] = held.get(now, 0) + 1
                    out.append([r.file, now, held[now], item])
            elif now is not None and held.get(now) and not r.disabled:
                row = next(x for x in reversed(out) if x[1] == now)
                row[3] = f"{row[3]} {r.text}".strip()
            elif not r.bullet:
                now = None
        return pd.DataFrame(out, columns=["file", "section", "item_no", "item"])

    return rows.select("file", "line_no", "text", "opens", "changelog", "bullet", "disabled").groupBy("file").applyInPandas(fold, "file string, section string, item_no int, item string")


def purpose(comments: DataFrame) -> DataFrame:
    """file, purpose: the first comment that isn't a header, bullet, warning, changelog or disabled line."""
    t = F.col("text")
    fit = ~F.col("decorative") & ~starts(t, "-") & comment_section(t).isNull() & ~is_disabled_job_line(t) & ~starts(F.upper(t), *fixed.NO_PURPOSE) & ~F.col("warning")
    return comments.where(fit).groupBy("file").agg(F.min_by("text", "line_no").alias("purpose"))


def highlights(comments: DataFrame, limit: int = 8) -> DataFrame:
    """file, highlights: the first comments that say something."""
    t = F.col("text")
    fit = comments.where(~F.col("decorative") & ~is_disabled_job_line(t) & ~starts(F.upper(t), "MODIFICATO"))
    return fit.groupBy("file").agg(F.transform(F.slice(F.array_sort(F.collect_list(F.struct("line_no", "text"))), 1, limit), lambda x: x["text"]).alias("highlights"))


def unresolved_procedures(steps: DataFrame) -> DataFrame:
    """file, proc, at: called procedures without a local definition, with the first call."""
    return steps.where("proc IS NOT NULL AND NOT resolved_locally").groupBy("file", "proc").agg(F.min("seq").alias("at"))


def warnings(comments: DataFrame, steps: DataFrame) -> DataFrame:
    """file, warnings: of comments, then of steps' notes, then of unresolved procedures; each once."""
    told = comments.where("warning").select("file", F.lit(0).alias("rank"), F.col("line_no").alias("at"), F.trim(F.ltrim("text", F.lit("- "))).alias("text"))
    noted = steps.select("file", "seq", "step", F.explode("notes").alias("note")).where(is_warning(F.col("note")))
    noted = noted.select("file", F.lit(1).alias("rank"), F.col("seq").alias("at"), F.concat_ws(": ", "step", "note").alias("text"))
    lost = unresolved_procedures(steps).select("file", F.lit(2).alias("rank"), "at", F.concat(F.lit("Unresolved procedure invocation: "), "proc").alias("text"))
    every = told.unionByName(noted).unionByName(lost)
    return every.groupBy("file").agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("rank", "at", "text"))), lambda x: x["text"])).alias("warnings"))


def analyse(lines: DataFrame, keep=lambda df: df) -> dict[str, DataFrame]:
    """All relations of job scripts from their lines(file, line_no, raw); ``keep`` is applied to what several are built from."""
    stmts, comments = keep(jcl.job_statements(lines)), jcl.job_comments(lines)
    steps = keep(jcl.steps(stmts))
    dds = keep(annotated(jcl.definitions(stmts), steps))
    executed = execution_steps(steps)
    usage = dataset_usage(executed, dds)
    return {
        "statements": stmts, "comments": comments, "steps": steps, "definitions": dds, "executed": executed, "usage": usage, "procedures": jcl.procedures(stmts),
        "catalog": dataset_catalog(usage), "flow": dataset_flow(usage), "step_datasets": step_datasets(dds), "control": jcl.control_statements(stmts), "symbols": jcl.symbols(stmts),
        "libraries": jcl.libraries(stmts), "step_comments": step_comments(steps, comments), "sections": comment_sections(comments), "purpose": purpose(comments),
        "highlights": highlights(comments), "warnings": warnings(comments, steps), "unresolved": unresolved_procedures(steps),
        "files": lines.select("file").distinct(),
        "jobs": jcl.with_context(stmts).groupBy("file").agg(F.first("job").alias("job")),
    }


def procedure_catalog(a: dict[str, DataFrame]) -> DataFrame:
    """procedure, source, job, programs, steps_count of every procedure defined in the batch."""
    inner = a["steps"].where("defined_in_proc IS NOT NULL").groupBy("file", F.col("defined_in_proc").alias("procedure"))
    inner = inner.agg(F.array_sort(F.collect_set("program")).alias("programs"), F.count(F.lit(1)).alias("steps_count"))
    rows = a["procedures"].join(inner, ["file", "procedure"], "left").join(a["jobs"], "file")
    return rows.select("procedure", F.col("file").alias("source"), "job", F.coalesce("programs", F.array().cast("array<string>")).alias("programs"), F.coalesce("steps_count", F.lit(0)).alias("steps_count"))


def validation(a: dict[str, DataFrame]) -> DataFrame:
    """One row a file: counts, unresolved procedures after a look through the whole batch, flags and status."""
    defined = a["procedures"].select(F.col("procedure").alias("proc"), F.col("file").alias("source"))
    lost = a["unresolved"]
    found = lost.alias("u").join(defined.alias("d"), (F.col("u.proc") == F.col("d.proc")) & (F.col("u.file") != F.col("d.source")), "left_semi")
    rest = lost.join(found, ["file", "proc"], "left_anti")
    n = lambda df, name: df.groupBy("file").agg(F.count(F.lit(1)).alias(name))
    unknown = a["definitions"].where("access_type = 'unknown' AND dsn <> ''")
    programs = a["steps"].groupBy("file").agg(F.array_sort(F.collect_set("program")).alias("programs"))
    out = a["files"].join(programs, "file", "left")
    for df, name in ((found, "n_batch_resolvable"), (rest, "n_unresolved"), (unknown, "n_unknown_dd"), (a["executed"], "execution_steps_count"), (a["catalog"], "datasets_count"), (a["control"], "control_statements_count")):
        out = out.join(n(df, name), "file", "left")
    out = out.na.fill(0).withColumn("programs", F.coalesce("programs", F.array().cast("array<string>"))).withColumn("zero_parsed_programs", F.size("programs") == 0)
    flags = F.array_compact(F.array(
        F.when(F.col("n_batch_resolvable") > 0, "procedure_resolvable_in_batch"), F.when(F.col("n_unresolved") > 0, "unresolved_procedure"),
        F.when(F.col("zero_parsed_programs"), "zero_parsed_programs"), F.when(F.col("n_unknown_dd") > 0, "unknown_dd_usage"),
    ))
    out = out.withColumn("flags", flags)
    bad = F.exists("flags", lambda f: f != "procedure_resolvable_in_batch")
    job = F.coalesce("job", F.upper(path_stem(F.col("file")))).alias("job")
    return out.join(a["jobs"], "file", "left").select("file", job, "programs", "execution_steps_count", "datasets_count", "control_statements_count", "n_batch_resolvable", "n_unresolved", "n_unknown_dd", "zero_parsed_programs", "flags", F.when(bad, "warning").otherwise("ok").alias("status"))


def validation_summary(validated: DataFrame, parse_errors: int = 0) -> DataFrame:
    n = F.count_if
    return validated.agg(
        (F.count(F.lit(1)) + parse_errors).alias("files_checked"), F.count(F.lit(1)).alias("files_parsed"), F.lit(parse_errors).cast("long").alias("parse_errors"),
        n(F.size("flags") > 0).alias("files_with_flags"), n(F.col("status") == "warning").alias("files_with_warnings"), n(F.col("n_unresolved") > 0).alias("files_with_unresolved_procedures"),
        n(F.col("n_batch_resolvable") > 0).alias("files_with_batch_resolvable_procedures"), n("zero_parsed_programs").alias("files_with_zero_parsed_programs"), n(F.col("n_unknown_dd") > 0).alias("files_with_unknown_dd_usage"),
    )


def file_use(a: dict[str, DataFrame], program: str) -> DataFrame:
    """Steps of all jobs that run a program, with the datasets of each access."""
    mine = a["steps"].where(F.col("program") == program.upper())
    return mine.join(a["step_datasets"].withColumnRenamed("step_seq", "seq"), ["file", "seq"], "left")


def job_documents(a: dict[str, DataFrame]) -> DataFrame:
    """id, type, job, source, embedding_text, content (JSON) of jobs, steps, datasets and warnings."""
    empty = F.array().cast("array<string>")
    safe = lambda c: safe_name(F.col(c))
    jobs = a["files"].join(a["jobs"], "file", "left").withColumn("job", F.coalesce("job", F.upper(path_stem(F.col("file")))))
    programs = a["steps"].groupBy("file").agg(F.array_sort(F.collect_set("program")).alias("programs"))
    lost = a["unresolved"].groupBy("file").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "proc"))), lambda x: x["proc"]).alias("unresolved"))
    sections = a["sections"].groupBy("file").pivot("section", list(fixed.COMMENT_SECTIONS.values())).agg(F.transform(F.array_sort(F.collect_list(F.struct("item_no", "item"))), lambda x: x["item"]))
    ran = a["executed"].groupBy("file").agg(F.count(F.lit(1)).alias("n_steps"))
    job = jobs
    for df in (a["purpose"], a["warnings"], programs, lost, sections, ran):
        job = job.join(df, "file", "left")
    lists = ["warnings", "programs", "unresolved", *fixed.COMMENT_SECTIONS.values()]
    job = job.select("file", "job", "purpose", F.coalesce("n_steps", F.lit(0)).alias("n_steps"), *[F.coalesce(c, empty).alias(c) for c in lists])
    text = F.format_string("JCL job %s. Purpose: %s. Programs: %s. Execution steps: %d. Warnings: %s. Unresolved procedures: %s.", "job", F.coalesce("purpose", F.concat(F.lit("JCL job "), "job")), preview(F.col("programs")), "n_steps", preview(F.col("warnings"), 3), preview(F.col("unresolved")))
    shape = lambda rows, i, kind, t, content: rows.select(i.alias("id"), F.lit(kind).alias("type"), "job", F.col("file").alias("source"), t.alias("embedding_text"), F.to_json(content, {"ignoreNullFields": "false"}).alias("content"))
    out = shape(job, F.concat(F.lit("JCL-JOB-"), safe("job")), "jcl_job", text, F.struct("purpose", "programs", "warnings", F.col("unresolved").alias("unresolved_procedures"), *fixed.COMMENT_SECTIONS.values()))
    steps = a["executed"].join(a["steps"].drop("step"), ["file", "seq"]).join(a["step_datasets"].withColumnRenamed("step_seq", "seq"), ["file", "seq"], "left").join(a["step_comments"], ["file", "seq"], "left")
    steps = steps.withColumn("comment_context", F.coalesce("comment_context", empty))
    for c in ("reads", "writes", "deletes", "controls"):
        steps = steps.withColumn(c, F.coalesce(c, empty))
    text = F.format_string("JCL job %s step %s executes %s. Reads: %s. Writes: %s. Deletes: %s. Controls: %s. Notes: %s.", "job", "step", F.coalesce("program", "proc", F.lit("UNKNOWN")), *[preview(F.col(c)) for c in ("reads", "writes", "deletes", "controls")], preview(F.concat("comment_context", "notes"), 3))
    out = out.unionByName(shape(steps, F.concat(F.lit("JCL-STEP-"), safe("job"), F.lit("-"), safe("step")), "jcl_step", text, F.struct("execution_order", "step", "program", "proc", "reads", "writes", "deletes", "controls", "notes", "comment_context")))
    text = F.format_string("JCL job %s dataset %s (%s). Produced by: %s. Consumed by: %s. Deleted by: %s. External input: %s.", "job", "dsn", F.coalesce("dataset_kind", F.lit("unknown kind")), preview(F.col("produced_by")), preview(F.col("consumed_by")), preview(F.col("deleted_by")), F.when(F.col("external_input"), "yes").otherwise("no"))
    out = out.unionByName(shape(a["catalog"], F.concat(F.lit("JCL-DSN-"), safe("job"), F.lit("-"), safe("dsn")), "jcl_dataset", text, F.struct("dsn", "dataset_kind", "external_input", "produced_by", "consumed_by", "controlled_by", "deleted_by")))
    warned = job.select("file", "job", F.posexplode("warnings").alias("n", "warning"))
    return out.unionByName(shape(warned, F.concat(F.lit("JCL-WARN-"), safe("job"), F.format_string("-%03d", F.col("n") + 1)), "jcl_warning", F.format_string("JCL job %s warning: %s", "job", "warning"), F.struct("warning")))
