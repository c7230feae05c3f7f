"""The document envelope: id, type, program, title, embedding_text, content and meta (JSON), evidence_ref, evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import call_intent, copybook_class, database_use
from ..functions.ids import joined_id
from ..sources import facts
from .relational import sorted_set

COLUMNS = ["id", "type", "program", "title", "embedding_text", "content", "meta", "evidence_ref", "evidence"]
_NONE = F.lit


def as_json(c: Column) -> Column:
    """JSON of a struct; null fields stay, as null."""
    return F.to_json(c, {"ignoreNullFields": "false"})


def document(rows: DataFrame, id_: Column, kind: Column, program: Column, title: Column, text: Column, content: Column, meta: Column, ref: Column | None = None, evidence: Column | None = None) -> DataFrame:
    return rows.select(
        id_.alias("id"), kind.alias("type"), program.alias("program"), title.alias("title"), text.alias("embedding_text"), as_json(content).alias("content"), as_json(meta).alias("meta"),
        (F.lit(None).cast("string") if ref is None else ref).alias("evidence_ref"), (F.array().cast("array<string>") if evidence is None else evidence).alias("evidence"),
    )


def evidence(recs: DataFrame, keep: Column, caps: list[tuple[Column, int]], limit: int) -> DataFrame:
    """program, evidence: lines of the records that ``keep`` takes, at most so many of each cap, in cap order and then line order."""
    rows = recs.where(keep)
    slices = [F.slice(F.array_sort(F.collect_list(F.when(c, F.struct("file", "line_no", "line")))), 1, n) for c, n in caps]
    return rows.groupBy("program").agg(F.transform(F.slice(F.concat(*slices), 1, limit), lambda x: x["line"]).alias("evidence"))


def _entity_evidence(recs: DataFrame, rec: str, keys: dict[str, Column], limit: int = 3) -> DataFrame:
    rows = recs.where(F.col("rec") == rec).select("program", "file", "line_no", "line", *[c.alias(k) for k, c in keys.items()])
    lines = F.slice(F.array_sort(F.collect_list(F.struct("file", "line_no", "line"))), 1, limit)
    return rows.groupBy("program", *keys).agg(F.transform(lines, lambda x: x["line"]).alias("evidence"))


def _names(c: Column) -> Column:
    return F.when(F.size(c) > 0, F.array_join(c, ", ")).otherwise("none")


def fact_documents(recs: DataFrame) -> DataFrame:
    """All documents of static-analysis records, one relation a type, unioned. ids are built in and stable."""
    p, is_ = F.col("program"), lambda r: F.col("rec") == r
    ident = lambda *parts: joined_id(p, *parts)
    ref = joined_id(p, F.lit("evidence.mapa_raw"), F.lit("raw"))
    src = F.struct(F.lit("mapa_result").alias("source"))
    last = F.upper(F.trim(F.element_at("parts", -1)))
    prior = F.upper(F.trim(F.try_element_at("parts", F.lit(-2))))
    out = []

    def add(rows, kind, title, text, content, meta=src, found=None, on=("program",)):
        ev = None
        if found is not None:
            rows = rows.join(found, list(on), "left")
            ev = F.coalesce("evidence", F.array().cast("array<string>"))
        out.append(document(rows, ident(F.lit(kind), title), F.lit(kind), p, title, text, content, meta, ref, ev))

    raw = recs.groupBy("program").agg(F.transform(F.array_sort(F.collect_list(F.struct("file", "line_no", "line"))), lambda x: x["line"]).alias("lines"))
    note = F.lit("Full raw MAPA lines for traceability. Other docs reference this via evidence_ref.").alias("note")
    out.append(document(raw, ref, F.lit("evidence.mapa_raw"), p, F.format_string("%s raw MAPA lines", p), F.format_string("Raw MAPA evidence for program %s.", p), F.struct("lines", note), src))

    books = facts.copybooks(recs).withColumn("class", copybook_class(F.col("name"))["label"])
    includes, tables, calls = facts.sql_includes(recs), facts.tables(recs), facts.calls(recs)
    dynamic, resources, other = facts.calls(recs, resolved=False), facts.resources(recs), facts.unhandled(recs)
    counts = lambda df, name: df.groupBy("program").agg(F.count(F.lit(1)).alias(name))
    m = facts.metrics(recs)
    for df, name in ((calls, "n_calls"), (dynamic, "n_dynamic"), (resources, "n_ops"), (other, "n_other")):
        m = m.join(counts(df, name), "program", "left")
    m = m.na.fill(0, ["n_calls", "n_dynamic", "n_ops", "n_other"])
    told = F.concat(
        F.format_string("%s is a COBOL CICS program discovered from MAPA.", p),
        F.when(F.col("loc").isNotNull() & F.col("paragraphs").isNotNull(), F.format_string(" It contains approximately %d LOC and %d paragraphs.", "loc", "paragraphs")).otherwise(""),
        F.when(F.coalesce("file_path", F.lit("")) != "", F.concat(F.lit(" Source file: "), "file_path", F.lit("."))).otherwise(""),
        F.when(F.col("n_dynamic") > 0, " It contains unresolved (dynamic) call targets.").otherwise(""),
        F.when(F.col("n_ops") > 0, " It performs CICS resource operations (READ/WRITE/etc.).").otherwise(""),
        F.when(F.col("n_other") > 0, " MAPA emitted additional record types that this parser does not yet model (see unhandled docs).").otherwise(""),
    )
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    text = F.format_string(
        "Program %s. COBOL CICS. LOC=%s, paragraphs=%s, statements=%s. Source=%s. Calls=%d. UnresolvedCalls=%d. CICSops=%d.",
        p, shown("loc"), shown("paragraphs"), shown("statements"), F.coalesce(F.nullif("file_path", F.lit("")), F.lit("unknown")), "n_calls", "n_dynamic", "n_ops",
    )
    begins = lambda r: F.startswith("line", F.lit(f"{r},"))  # noqa: E731  only records written in capitals are shown
    caps = [(begins("FILE"), 1), (begins("PGM"), 1), (begins("CALL"), 2), (begins("UNRESOLVEDCALL"), 1), (begins("DB2TABLE"), 1)]
    summary_meta = F.struct(F.lit("mapa_result").alias("source"), "file_timestamp", "loc", "paragraphs", "statements")
    add(m.withColumn("told", told), "program.summary", F.format_string("%s overview", p), text, F.struct(F.col("told").alias("text")), summary_meta, evidence(recs, F.lit(True), caps, 6))

    base = recs.select("program").distinct()
    kinds = {"ui_cics": "UI/CICS", "business": "Business", "utilities": "Utilities", "state_context": "State", "error_handling": "Errors"}
    sets = [sorted_set(F.when(F.col("class") == k, F.col("name"))).alias(k) for k in kinds]
    by_class = F.collect_list(F.struct("class", "name"))
    grouped = books.groupBy("program").agg(sorted_set("name").alias("all"), by_class.alias("pairs"), *sets)
    labels = F.array_sort(F.array_distinct(F.transform("pairs", lambda x: x["class"])))
    of = lambda k: F.array_sort(F.transform(F.filter("pairs", lambda x: x["class"] == k), lambda x: x["name"]))
    classified = F.map_from_entries(F.transform(labels, lambda k: F.struct(k, of(k))))
    sizes = F.map_from_entries(F.transform(labels, lambda k: F.struct(k, F.size(of(k)))))
    empty = F.array().cast("array<string>")
    all_books = base.join(grouped, "program", "left").select("program", F.coalesce("all", empty).alias("all"), classified.alias("classified"), sizes.alias("counts"), *[F.coalesce(k, empty).alias(k) for k in kinds])
    text = F.concat(F.format_string("%s copybooks. ", p), F.concat_ws(". ", *[F.concat(F.lit(f"{name}="), _names(F.col(k))) for k, name in kinds.items()]), F.lit("."))
    hint = F.lit("Categories are heuristic; treat as hints, not ground truth.").alias("classification_note")
    add(all_books, "architecture.copybooks", F.format_string("%s copybooks", p), text, F.struct("all", "classified", hint), F.struct(F.lit("mapa_result").alias("source"), "counts"), evidence(recs, begins("COPY"), [(F.lit(True), 5)], 5))

    use = tables.groupBy("program").agg(sorted_set("table").alias("db2_tables"), F.array_sort(F.collect_list(F.struct("line_no", "table", "stmt_type"))).alias("uses"))
    db = base.join(includes.groupBy("program").agg(sorted_set("name").alias("sql_includes")), "program", "left").join(use, "program", "left")
    db = db.select("program", F.coalesce("sql_includes", empty).alias("sql_includes"), F.coalesce("db2_tables", empty).alias("db2_tables"), F.transform("uses", lambda x: F.struct(x["table"].alias("table"), x["stmt_type"].alias("stmt_type"))).alias("db2_usage"))
    db = db.withColumn("u", database_use(F.col("db2_tables")))
    text = F.format_string("%s database footprint. SQL includes: %s. DB2 tables: %s. Interpretation: %s (conf=%s).", p, _names(F.col("sql_includes")), _names(F.col("db2_tables")), "u.label", F.col("u.confidence").cast("string"))
    content = F.struct("sql_includes", "db2_tables", "db2_usage", F.col("u.label").alias("interpretation"), F.col("u.confidence").alias("interpretation_confidence"))
    add(db, "architecture.database", F.format_string("%s database footprint", p), text, content, src, evidence(recs, begins("SQLINCLUDE") | begins("DB2TABLE"), [(begins("SQLINCLUDE"), 6), (begins("DB2TABLE"), 6)], 6))

    content = F.struct(F.col("name").alias("include"))
    add(includes, "architecture.sqlinclude", F.format_string("%s SQLINCLUDE %s", p, "name"), F.format_string("%s includes SQL include %s (embedded SQL support).", p, "name"), content, src, _entity_evidence(recs, "SQLINCLUDE", {"name": last}), ("program", "name"))
    title = F.trim(F.format_string("%s DB2TABLE %s %s", p, "table", "stmt_type"))
    text = F.format_string("%s accesses DB2 table %s via %s.", p, "table", F.coalesce(F.nullif("stmt_type", F.lit("")), F.lit("unknown_statement_type")))
    of_table = F.when(F.size("parts") >= 5, F.upper(F.trim(F.get("parts", F.lit(3))))).otherwise(prior)
    add(tables, "architecture.db2_table", title, text, F.struct("table", "stmt_type"), src, _entity_evidence(recs, "DB2TABLE", {"table": of_table}), ("program", "table"))

    kinds_of = calls.groupBy("program", "call_type").agg(sorted_set("target").alias("targets"), F.min("line_no").alias("at"))
    kinds_of = kinds_of.withColumn("i", call_intent(F.col("call_type"), F.get("targets", F.lit(0))))
    entry = F.struct("at", "call_type", F.struct("targets", F.col("i.label").alias("heuristic_intent"), F.col("i.confidence").alias("intent_confidence")).alias("v"))
    summed = base.join(kinds_of.groupBy("program").agg(F.array_sort(F.collect_list(entry)).alias("e")), "program", "left")
    told = F.array_join(F.transform("e", lambda x: F.concat(x["call_type"], F.lit(": "), F.array_join(x["v"]["targets"], ", "))), " ")
    text = F.when(F.col("e").isNull(), F.format_string("%s calls summary: no calls detected.", p)).otherwise(F.concat(F.format_string("%s calls summary. ", p), told))
    content = F.coalesce(F.map_from_entries(F.transform("e", lambda x: F.struct(x["call_type"], x["v"]))), F.from_json(F.lit("{}"), "map<string,struct<targets:array<string>,heuristic_intent:string,intent_confidence:double>>"))
    add(summed, "architecture.calls", F.format_string("%s call summary", p), text, content, src, evidence(recs, begins("CALL"), [(F.lit(True), 5)], 5))
    intent = call_intent(F.col("call_type"), F.col("target"))
    each = calls.withColumn("i", intent)
    text = F.format_string("%s calls %s using %s. Intent: %s (conf=%s).", p, "target", "call_type", "i.label", F.col("i.confidence").cast("string"))
    note = F.lit("Intent labels are heuristic; verify against COBOL/CFG for accuracy.").alias("note")
    content = F.struct(p.alias("caller"), "call_type", "target", F.col("i.label").alias("heuristic_intent"), F.col("i.confidence").alias("intent_confidence"), note)
    add(each, "architecture.call", F.format_string("%s %s -> %s", p, "call_type", "target"), text, content, src, _entity_evidence(recs, "CALL", {"call_type": prior, "target": last}), ("program", "call_type", "target"))

    def summary_of(rows, key, value, kind, title, lead, seen):
        held = rows.groupBy("program", key).agg(sorted_set(value).alias("v"), F.min("line_no").alias("at"))
        one = held.groupBy("program").agg(F.array_sort(F.collect_list(F.struct("at", F.col(key).alias("k"), "v"))).alias("e"))
        told = F.array_join(F.transform("e", lambda x: F.concat(x["k"], F.lit(": "), F.array_join(x["v"], ", "))), " ")
        add(one, kind, F.format_string(title, p), F.concat(F.format_string(lead, p), told), F.map_from_entries(F.transform("e", lambda x: F.struct(x["k"], x["v"]))), src, seen)

    summary_of(dynamic, "call_type", "target", "architecture.unresolved_calls", "%s unresolved call summary", "%s has unresolved (dynamic) calls. ", evidence(recs, begins("UNRESOLVEDCALL"), [(F.lit(True), 5)], 5))
    note = F.lit("MAPA could not resolve this target statically (likely dynamic CALL/LINK).").alias("note")
    content = F.struct(p.alias("caller"), "call_type", F.col("target").alias("target_hint"), note)
    add(dynamic, "architecture.unresolved_call", F.format_string("%s %s ~> %s", p, "call_type", "target"), F.format_string("%s has unresolved call via %s with target hint %s.", p, "call_type", "target"), content, src, _entity_evidence(recs, "UNRESOLVEDCALL", {"call_type": prior, "target": last}), ("program", "call_type", "target"))
    monitor = F.startswith("rec", F.lit("CICS"))
    summary_of(resources, "operation", "resource", "architecture.cics_resources", "%s CICS resource operations", "%s performs CICS resource operations. ", evidence(recs, monitor, [(F.lit(True), 6)], 6))
    seen = recs.where(monitor).select("program", F.col("rec").alias("operation"), last.alias("resource"), "file", "line_no", "line").groupBy("program", "operation", "resource")
    seen = seen.agg(F.transform(F.slice(F.array_sort(F.collect_list(F.struct("file", "line_no", "line"))), 1, 3), lambda x: x["line"]).alias("evidence"))
    add(resources, "architecture.cics_resource_op", F.format_string("%s %s %s", p, "operation", "resource"), F.format_string("%s does %s on resource %s.", p, "operation", "resource"), F.struct("operation", "resource"), src, seen, ("program", "operation", "resource"))
    one = other.groupBy("program").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("minus"), "rec", "n", "examples"))).alias("e"))
    told = F.array_join(F.transform("e", lambda x: F.concat(x["rec"], F.lit("("), x["n"].cast("string"), F.lit(")"))), ", ")
    content = F.struct(F.map_from_entries(F.transform("e", lambda x: F.struct(x["rec"], x["n"]))).alias("counts"), F.map_from_entries(F.transform("e", lambda x: F.struct(x["rec"], x["examples"]))).alias("examples"))
    add(one, "analysis.unhandled_records", F.format_string("%s unhandled MAPA record types", p), F.concat(F.format_string("%s has unhandled MAPA record types: ", p), told), content)
    everywhere = other.groupBy("rec").agg(F.sum("n").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("rec", "n")))).alias("counts")).where("size(counts) > 0")
    out.append(document(everywhere, joined_id(F.lit("GLOBAL"), F.lit("analysis.mapa_unhandled"), F.lit("all")), F.lit("analysis.mapa_unhandled"), F.lit("GLOBAL"), F.lit("Unhandled MAPA record types"), F.lit("Record types of all programs that have no table."), F.struct("counts"), src))
    result = out[0]
    for df in out[1:]:
        result = result.unionByName(df)
    return result


def of_type(docs: DataFrame, kind: str, program: str | None = None, first: bool = False) -> DataFrame:
    """Documents of a type (and program); with ``first`` the one of the smallest id."""
    rows = docs.where(F.col("type") == kind)
    rows = rows if program is None else rows.where(F.col("program") == program.upper())
    return rows.orderBy("id").limit(1) if first else rows
