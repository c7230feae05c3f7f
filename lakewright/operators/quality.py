"""Checks of packages, outputs and the index, and folder comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import before_comma, path_stem
from .relational import first_by_priority

REQUIRED = ("id", "program", "type", "text", "metadata")


def json_line_quality(lines: DataFrame) -> DataFrame:
    """One row: lines, invalid, duplicate ids (every one after the first), empty texts, records that lack a field, valid.

    lines(doc VARIANT, null on a bad line), as sources.documents.json_lines() gives them.
    """
    get = lambda f, kind="string": F.expr(f"try_variant_get(doc, '$.{f}', '{kind}')")
    object_ = F.startswith(F.schema_of_variant("doc"), F.lit("OBJECT"))
    has = lambda f: F.expr(f"exists(json_object_keys(to_json(doc)), k -> k = '{f}')")
    rows = lines.withColumn("ok", F.coalesce(object_, F.lit(False)))
    lacks = F.lit(False)
    for f in REQUIRED:
        lacks = lacks | ~F.coalesce(has(f), F.lit(False))
    rows = rows.select("ok", F.nullif(get("id"), F.lit("")).alias("id"), (F.length(F.trim(F.coalesce(get("text"), F.lit("")))) == 0).alias("blank"), lacks.alias("lacks"))
    ids = rows.where("ok AND id IS NOT NULL").groupBy("id").agg((F.count(F.lit(1)) - 1).alias("more"))
    again = ids.agg(F.coalesce(F.sum("more"), F.lit(0)).alias("duplicate_ids"))
    ok = F.col("ok")
    out = rows.agg(F.count(F.lit(1)).alias("line_count"), F.count_if(~ok).alias("invalid_lines"), F.count_if(ok & F.col("blank")).alias("empty_text"), F.count_if(ok & F.col("lacks")).alias("missing_required_fields"))
    out = out.crossJoin(again)  # one row each
    bad = F.col("invalid_lines") + F.col("duplicate_ids") + F.col("empty_text") + F.col("missing_required_fields")
    return out.withColumn("valid", (bad == 0) & (F.col("line_count") > 0))


def program_status(packages: DataFrame, outputs: DataFrame) -> DataFrame:
    """program, status (OK, WARN, FAIL), notes: a full outer join of what was packaged and what came out.

    packages(program, cobol_count, manifest_valid, has_mapa, has_controlflow, copybook_count, missing_copybooks);
    outputs(program, invalid_json, missing_artifacts array).
    """
    p = packages.withColumn("in_p", F.lit(True))
    rows = p.join(outputs.withColumn("in_o", F.lit(True)), "program", "full_outer")
    has_p, has_o = F.col("in_p").isNotNull(), F.col("in_o").isNotNull()
    listed = F.concat(F.lit("missing artifacts: "), F.array_join(F.slice("missing_artifacts", 1, 5), ", "), F.when(F.size("missing_artifacts") > 5, F.format_string(", +%d more", F.size("missing_artifacts") - 5)).otherwise(""))
    of = lambda c: has_p & F.coalesce(c, F.lit(False))
    checks = [
        (of(F.col("cobol_count") == 0), "FAIL", F.lit("missing COBOL source")),
        (of(F.col("cobol_count") > 1), "WARN", F.format_string("%d COBOL sources in package", "cobol_count")),
        (of(~F.col("manifest_valid")), "WARN", F.lit("invalid package manifest")),
        (of(~F.col("has_mapa")), "FAIL", F.lit("missing MAPA")),
        (of(~F.col("has_controlflow")), "FAIL", F.lit("missing controlflow")),
        (of((F.col("copybook_count") > 0) & (F.col("missing_copybooks") > 0)), "WARN", F.format_string("missing %d copybooks", "missing_copybooks")),
        (of(F.col("copybook_count") == 0), "WARN", F.lit("no copybooks packaged")),
        (~has_p, "WARN", F.lit("no input package")),
        (~has_o, "FAIL", F.lit("no pipeline output")),
        (has_o & F.coalesce(F.col("invalid_json") > 0, F.lit(False)), "FAIL", F.format_string("%d invalid JSON files", "invalid_json")),
        (has_o & F.coalesce(F.size("missing_artifacts") > 0, F.lit(False)), "WARN", listed),
    ]
    notes = F.array_compact(F.array(*[F.when(c, note) for c, _, note in checks]))
    levels = F.array_compact(F.array(*[F.when(c, level) for c, level, _ in checks]))
    status = F.when(F.array_contains(levels, "FAIL"), "FAIL").when(F.array_contains(levels, "WARN"), "WARN").otherwise("OK")
    return rows.select("program", status.alias("status"), F.when(F.size(notes) == 0, F.array(F.lit("ready"))).otherwise(notes).alias("notes"))


def status_summary(statuses: DataFrame) -> DataFrame:
    n = lambda s: F.count_if(F.col("status") == s).alias(s.lower())
    return statuses.agg(F.count(F.lit(1)).alias("program_count"), *map(n, ("OK", "WARN", "FAIL")))


def top_reasons(statuses: DataFrame, k: int = 20) -> DataFrame:
    """note, n: the most frequent notes; ties by the first program that has it, then by text."""
    rows = statuses.select("program", F.explode("notes").alias("note")).where("note <> 'ready'")
    return rows.groupBy("note").agg(F.count(F.lit(1)).alias("n"), F.min("program").alias("first")).orderBy(F.desc("n"), "first", "note").limit(k).select("note", "n")


def packages(programs: DataFrame, references: DataFrame, copybooks: DataFrame, facts: DataFrame, graphs: DataFrame, jobs: DataFrame) -> DataFrame:
    """One row a program: what its package holds and lacks.

    programs(file, program), references(file, copybook), copybooks/facts/graphs(file), jobs(file, text). Names are looked
    up by stem; a record or graph file that is the only one serves every program; a job belongs to the program that it
    is named after, or that its text names.
    """
    stem = F.upper(path_stem(F.col("file")))
    books = copybooks.select(stem.alias("copybook")).distinct().withColumn("there", F.lit(True))
    need = references.join(books, "copybook", "left").groupBy("file").agg(F.array_sort(F.collect_set(F.when(F.col("there"), F.col("copybook")))).alias("copybooks"), F.array_sort(F.collect_set(F.when(F.col("there").isNull(), F.col("copybook")))).alias("missing_copybooks"))
    keyed = programs.select("file", "program", F.array_distinct(F.array(F.upper("program"), stem)).alias("key"), F.col("file").alias("id"))

    def found(df: DataFrame, name: str) -> DataFrame:
        candidates = df.select(F.col("file").alias(name), F.upper(path_stem(F.col("file"))).alias("key"))
        only = df.agg(F.when(F.count(F.lit(1)) == 1, F.max("file")).alias("only"))
        return first_by_priority(keyed, candidates, "key", name).crossJoin(F.broadcast(only)).select("file", F.coalesce(name, "only").alias(name))

    own = jobs.select(F.col("file").alias("job_file"), F.upper(path_stem(F.col("file"))).alias("job"), F.upper("text").alias("text"))
    by_name = keyed.select("file", F.explode("key").alias("job")).join(own.select("job", "job_file"), "job").select("file", "job_file")
    # Words of each script, equi-joined with the programs' names.
    said = own.select("job_file", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("([A-Z0-9$#@-]+)"), 1))).alias("word"))
    by_text = keyed.select("file", F.explode("key").alias("word")).join(said, "word").select("file", "job_file")
    jobs_of = by_name.union(by_text.join(by_name.select("file").distinct(), "file", "left_anti")).groupBy("file").agg(F.array_sort(F.collect_set("job_file")).alias("jobs"))
    out = programs.join(need, "file", "left").join(found(facts, "mapa"), "file", "left").join(found(graphs, "controlflow"), "file", "left").join(jobs_of, "file", "left")
    empty = F.array().cast("array<string>")
    return out.select("program", "file", *[F.coalesce(c, empty).alias(c) for c in ("copybooks", "missing_copybooks", "jobs")], "mapa", "controlflow")


def located(names: DataFrame, sources: DataFrame) -> DataFrame:
    """name, status (FOUND, MISSING, AMBIGUOUS), file of the sources by stem."""
    by = sources.groupBy(F.upper(path_stem(F.col("file"))).alias("name")).agg(F.count(F.lit(1)).alias("n"), F.min("file").alias("file"))
    status = F.when(F.col("n").isNull(), "MISSING").when(F.col("n") > 1, "AMBIGUOUS").otherwise("FOUND")
    return names.select(F.upper("name").alias("name")).distinct().join(by, "name", "left").select("name", status.alias("status"), F.when(status == "FOUND", F.col("file")).alias("file"))


def compare_folders(left: DataFrame, right: DataFrame) -> DataFrame:
    """key, status (LEFT_ONLY, RIGHT_ONLY, SAME, DIFFERENT) of files(key, content) by their bytes' hash: contents aren't shuffled."""
    hashed = lambda df, s: df.select("key", F.sha2(F.col("content").cast("binary"), 256).alias(s))
    both = hashed(left, "l").join(hashed(right, "r"), "key", "full_outer")
    status = F.when(F.col("r").isNull(), "LEFT_ONLY").when(F.col("l").isNull(), "RIGHT_ONLY").when(F.col("l") == F.col("r"), "SAME").otherwise("DIFFERENT")
    return both.select("key", status.alias("status"))


def compare_line_prefixes(left: DataFrame, right: DataFrame) -> DataFrame:
    """key, n_left, n_right, first_mismatch (line, null if none) of lines(key, line_no, raw) by what stands before the first comma."""
    side = lambda df, s: df.select("key", "line_no", before_comma(F.col("raw")).alias(s))
    both = side(left, "l").join(side(right, "r"), ["key", "line_no"], "full_outer")
    return both.groupBy("key").agg(F.count("l").alias("n_left"), F.count("r").alias("n_right"), F.min(F.when(~F.col("l").eqNullSafe(F.col("r")), F.col("line_no"))).alias("first_mismatch"))


def duplicates(df: DataFrame, key: str, order: str) -> DataFrame:
    """Rows after the first of each key."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("__n > 1").drop("__n")
