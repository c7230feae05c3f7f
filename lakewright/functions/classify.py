"""Classification chains: the first rule that holds decides. All are CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed
from .text import collapse, disposition, disposition_status, strip, upper_name


def chain(rules: list[tuple[Column, object]], otherwise: object) -> Column:
    """CASE WHEN over (condition, value) pairs."""
    value = lambda v: v if isinstance(v, Column) else F.lit(v)
    out = F.when(rules[0][0], value(rules[0][1]))
    for condition, v in rules[1:]:
        out = out.when(condition, value(v))
    return out.otherwise(value(otherwise))


def starts(c: Column, *prefixes: str) -> Column:
    """c starts with one of the prefixes; null gives null."""
    out = F.startswith(c, F.lit(prefixes[0]))
    for p in prefixes[1:]:
        out = out | F.startswith(c, F.lit(p))
    return out


def holds(c: Column, *tokens: str) -> Column:
    out = F.contains(c, F.lit(tokens[0]))
    for t in tokens[1:]:
        out = out | F.contains(c, F.lit(t))
    return out


def _labelled(label: str, confidence: float) -> Column:
    return F.struct(F.lit(label).alias("label"), F.lit(confidence).alias("confidence"))


def copybook_class(name: Column) -> Column:
    """struct(label, confidence) of a copybook's name."""
    n = upper_name(name)
    return chain(
        [
            (starts(n, "DFH"), _labelled("ui_cics", 0.95)),
            (starts(n, "PDPSQL", "PDWSQL", "SQL") | F.endswith(n, F.lit("SQLER")), _labelled("sql", 0.85)),
            (holds(n, "ABEND") | starts(n, "PDI"), _labelled("error_handling", 0.75)),
            (holds(n, "UTI"), _labelled("utilities", 0.65)),
            (holds(n, "SAV", "TWA"), _labelled("state_context", 0.55)),
            (holds(n, "SEMA"), _labelled("utilities", 0.6)),
            (starts(n, "PD", "PR", "PX"), _labelled("business", 0.45)),
        ],
        _labelled("unknown", 0.2),
    )


def call_intent(call_type: Column, target: Column) -> Column:
    """struct(label, confidence) of a call."""
    kind, t = upper_name(call_type), upper_name(target)
    return chain(
        [
            (holds(kind, "CICSXCTL"), _labelled("control_transfer", 0.9)),
            (holds(kind, "CICSLINK"), _labelled("sync_service_call", 0.7)),
            (holds(kind, "CALL") & holds(t, "SEMA"), _labelled("concurrency_or_locking", 0.55)),
            (holds(kind, "CALL") & holds(t, "UTI"), _labelled("utility_service", 0.55)),
            (holds(kind, "CALL"), _labelled("subprogram_call", 0.45)),
        ],
        _labelled("unknown", 0.2),
    )


def database_use(tables: Column) -> Column:
    """struct(label, confidence) of a program's tables (upper-cased names)."""
    held = F.array_distinct(F.filter(tables, lambda t: t.isNotNull() & (t != "")))
    return chain(
        [
            (F.size(held) == 0, _labelled("no_db2_tables_detected", 0.9)),
            ((F.size(held) == 1) & (F.get(held, F.lit(0)) == "DUAL"), _labelled("light_db_usage_likely_validation_or_constant_select", 0.7)),
        ],
        _labelled("db2_tables_accessed", 0.7),
    )


# --- rules -------------------------------------------------------------------------------------------


def rule_category(target: Column, edge_type: Column) -> Column:
    t, kind = F.upper(F.coalesce(target, F.lit(""))), F.upper(F.coalesce(edge_type, F.lit("")))
    return chain(
        [
            (holds(t, "ABEND"), "error"),
            (holds(t, "XCTL"), "permission"),
            (kind.isin("CALL", "CALL_RANGE"), "precondition"),
            (t.isin("RETURN", "EXIT"), "validation"),
        ],
        "control",
    )


def rule_kind(category: Column, condition: Column) -> Column:
    c, serious = F.upper(F.coalesce(condition, F.lit(""))), category.isin("error", "permission", "precondition", "validation")
    return chain(
        [
            (holds(c, *fixed.SCREEN_TOKENS), "ui"),
            (holds(c, *fixed.PAGING_TOKENS), "technical"),
            (holds(c, *fixed.MODE_TOKENS) & serious, "business"),
            (holds(c, *fixed.MODE_TOKENS), "business_logic"),
            (holds(c, fixed.STATE_TOKEN), "state"),
            (serious, "business"),
        ],
        "control",
    )


def rule_severity(category: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in fixed.SEVERITY.items() for x in pair])
    return F.coalesce(F.try_element_at(table, category), F.lit("neutral"))


def rule_flags(condition: Column) -> Column:
    return F.when(condition.rlike(fixed.INVERTED), F.array(F.lit(fixed.INVERTED_FLAG))).otherwise(F.array().cast("array<string>"))


# --- comments ----------------------------------------------------------------------------------------


def bare_comment(c: Column) -> Column:
    """A comment without the stars and slashes round it."""
    return _bare(collapse(c))


def _bare(collapsed: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(collapsed, r"^[*/\s]+", ""), r"[\s*]+$", ""))


def is_noise(c: Column) -> Column:
    """Blank, or without a letter or digit."""
    return ~F.coalesce(c, F.lit("")).rlike("[A-Za-z0-9]")


_THREE_WORDS = "^[^A-Z0-9-]*+(?:[A-Z0-9-]++[^A-Z0-9-]++){2}[A-Z0-9-]"


def _words(c: Column) -> Column:
    return F.regexp_extract_all(F.upper(c), F.lit("([A-Z0-9-]+)"), 1)


def code_score(bare: Column) -> Column:
    """How much a comment looks like disabled code; 4 or more is code."""
    i = "(?i)"
    point = lambda condition, n: F.when(condition, n).otherwise(0)
    lone = bare.rlike(r"^[A-Z0-9-]+\.\s*$") & ~F.rtrim(bare, F.lit(".")).rlike("^[A-Z][A-Z0-9-]{2,}$")
    return (
        point(bare.rlike(fixed.LEVEL), 4)
        + point(bare.rlike(i + fixed.VERB), 4)
        + point(bare.rlike(i + r"^\s*(TO|FROM|INTO|BY)\b"), 3)
        + point(bare.rlike(i + fixed.OPENING), 3)
        + point(bare.rlike(i + fixed.CLAUSE), 2)
        + point(bare.rlike(i + r"\b(TO|FROM|INTO|BY|USING|GIVING)\b"), 1)
        + point(lone, 1)
        + point(F.endswith(bare, F.lit(".")), 1)
    )


def is_code(bare: Column) -> Column:
    """code_score(bare) >= 4, found without looking for what can't decide: a line without a full stop at its end needs no search."""
    i = "(?i)"
    opened = bare.rlike(i + r"^\s*(TO|FROM|INTO|BY)\b") | bare.rlike(i + fixed.OPENING)  # 3 points; both can't be
    lone = bare.rlike(r"^[A-Z0-9-]+\.\s*$") & ~F.rtrim(bare, F.lit(".")).rlike("^[A-Z][A-Z0-9-]{2,}$")
    ended = F.endswith(bare, F.lit("."))
    clause = bare.rlike(i + fixed.CLAUSE)
    named = bare.rlike(i + r"\b(TO|FROM|INTO|BY|USING|GIVING)\b")
    sure = bare.rlike(fixed.LEVEL) | bare.rlike(i + fixed.VERB)
    # Of the last three, two are needed beside a clause, and one beside an opening.
    return chain([(sure, True), (opened, ended | lone | named | clause), (~ended & ~lone, False)], ((ended & lone) | named) & clause)


def with_comment_class(df: DataFrame, text: str, into: str = "classification") -> DataFrame:
    """df with a comment's class: commented_out_code, section_header, name_or_reference, descriptive_header or explanatory_comment.

    What several rules look at is computed once, in columns of its own: branches of a CASE share nothing.
    """
    df = df.withColumn("__raw", collapse(F.col(text)))
    df = df.withColumn("__bare", _bare(F.col("__raw")))
    # Only one word or two decide anything: none stand for more.
    words = F.when(F.upper("__bare").rlike(_THREE_WORDS), F.array().cast("array<string>")).otherwise(_words(F.col("__bare")))
    df = df.withColumn("__words", words).withColumn("__structural", F.col("__bare").rlike("(?i)" + fixed.DIVISION) | F.col("__bare").rlike("(?i)" + fixed.SECTION))
    return df.withColumn(into, _comment_class(F.col("__bare"), F.col("__raw"), F.col("__words"), F.col("__structural"))).drop("__raw", "__bare", "__words", "__structural")


def _comment_class(s: Column, raw: Column, words: Column, structural: Column) -> Column:
    u = F.upper(s)
    few = F.size(words).between(1, 2)
    header = u.isin(*fixed.HEADER_TERMS) | structural | u.rlike(r"^[A-Z](\s+[A-Z]){2,}$") | (few & F.array_join(words, " ").isin(*fixed.HEADER_TERMS))
    name = F.forall(words, lambda w: w.rlike("^[A-Z][A-Z0-9-]{1,30}$"))
    single = (F.size(words) == 1) & name & ~F.get(words, F.lit(0)).isin(*fixed.HEADER_TERMS)
    pair = (F.size(words) == 2) & name & F.exists(words, lambda w: w.rlike("[0-9-]"))
    reference = (single | pair) & ~s.rlike("[:/()]")
    titled = F.when(raw.rlike(r"^-{2,}\s*\S"), F.regexp_replace(s, r"^-+\s*", "")).otherwise(s)
    n_words = F.size(F.regexp_extract_all(titled, F.lit("([A-Za-z0-9'-]+)"), 1))
    short = ~titled.rlike(r"\p{Ll}") & n_words.between(1, 12) & ~raw.rlike(r"^(- |\(|[0-9]+\s*=)")
    described = short & (starts(F.upper(titled), *fixed.HEADER_PREFIXES) | (~F.endswith(titled, F.lit(".")) & (n_words <= 8)))
    return chain(
        [
            ((s != "") & ~structural & is_code(s), "commented_out_code"),
            ((s != "") & header, "section_header"),
            ((s != "") & reference, "name_or_reference"),
            (described, "descriptive_header"),
        ],
        "explanatory_comment",
    )


def comment_reason(label: Column, kind: Column, in_procedure: Column) -> Column:
    return chain(
        [
            (label == "commented_out_code", "Looks like disabled COBOL code or a data declaration."),
            (label == "section_header", "Looks like a structural COBOL division, section, or banner header."),
            (label == "name_or_reference", "Looks like an identifier, file name, copybook name, or short reference label."),
            (label == "descriptive_header", "Looks like a short descriptive banner for a data area or processing step."),
            ((kind == "inline") & ~in_procedure, "Inline natural-language comment outside PROCEDURE DIVISION."),
        ],
        "Looks like a natural-language explanatory comment.",
    )


def is_indexable(label: Column) -> Column:
    return label.isin("descriptive_header", "explanatory_comment")


# --- job control -------------------------------------------------------------------------------------


def dataset_kind(dsn: Column) -> Column:
    u = F.upper(F.nullif(dsn, F.lit("")))
    return F.when(starts(u, "&&"), "temporary").when(starts(u, "SYS1.", "SYSOUT"), "system").when(u.isNotNull(), "persistent")


def dataset_access(ddname: Column, disp: Column, sysout: Column, raw: Column, dsn: Column, program: Column) -> Column:
    """struct(access_type, access_reason) of a DD statement."""
    d, status, name = disposition(disp), disposition_status(disp), upper_name(ddname)
    has_dsn = F.coalesce(dsn != "", F.lit(False))
    out = lambda kind, why: F.struct(F.lit(kind).alias("access_type"), F.lit(why).alias("access_reason"))
    return chain(
        [
            (F.coalesce(sysout != "", F.lit(False)), out("sysout", "SYSOUT destination")),
            (holds(F.upper(F.coalesce(raw, F.lit(""))), "DUMMY") & ~has_dsn, out("control", "DUMMY DD")),
            (name.isin(*fixed.CONTROL_DD), out("control", "Control DD name")),
            ((program == "IEFBR14") & holds(d, "DELETE"), out("delete", "IEFBR14 cleanup pattern")),
            (name.isin(*fixed.READ_DD), out("read", "Input DD name")),
            (name.isin(*fixed.WRITE_DD), out("write", "Output DD name")),
            (status.isin("OLD", "SHR"), out("read", "DISP references an existing dataset")),
            (status.isin("NEW", "MOD"), out("write", "DISP creates or updates a dataset")),
            (starts(d, "(,") | holds(d, "(,CATLG", "(,PASS"), out("write", "DISP implies dataset creation")),
            (has_dsn, out("unknown", "Dataset present but access is ambiguous")),
        ],
        out("control", "Non-dataset DD"),
    )


def is_decorative(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"[\s*/|#=_.:-]+", "") == ""


def is_warning(c: Column) -> Column:
    return holds(F.upper(F.coalesce(c, F.lit(""))), *fixed.WARNING_WORDS)


def is_disabled_job_line(c: Column) -> Column:
    u = F.upper(strip(F.coalesce(c, F.lit(""))))
    return (
        starts(u, "***", "**MIGR ", "*STEPLIB ", *fixed.JOB_PARAMETERS, *fixed.JOB_WORDS)
        | (starts(u, "*") & (holds(u, *fixed.JOB_PARAMETERS) | holds(u, " DD ")))
        | u.rlike(r"^[A-Z0-9$#@-]+\s+(DD|EXEC|PROC|JOB)\b")
    )


def comment_section(c: Column) -> Column:
    """Key of the section that a job comment opens, else null."""
    u = strip(F.rtrim(F.upper(F.coalesce(c, F.lit(""))), F.lit(":")))
    out = F.lit(None).cast("string")
    for header, key in fixed.COMMENT_SECTIONS.items():
        out = F.coalesce(out, F.when(starts(u, header), key))
    return out


# --- reports -----------------------------------------------------------------------------------------


def readiness(fail: Column, warn: Column, index_checked: Column, index_valid: Column) -> Column:
    """UNKNOWN without a validation (null counts), else NOT_READY, READY_WITH_WARNINGS or READY."""
    return chain(
        [
            (fail.isNull(), "UNKNOWN"),
            (fail > 0, "NOT_READY"),
            (F.coalesce(index_checked, F.lit(False)) & ~F.coalesce(index_valid, F.lit(False)), "NOT_READY"),
            (F.coalesce(warn, F.lit(0)) > 0, "READY_WITH_WARNINGS"),
        ],
        "READY",
    )


def comparison_profile(recall: Column, precision: Column, left_only: Column, right_only: Column, left: str, right: str) -> Column:
    return chain(
        [
            ((recall >= 0.99) & (precision >= 0.99) & (left_only == 0) & (right_only == 0), f"{right} is effectively identical to {left}."),
            (recall >= precision + 0.05, f"{right} is more expansive than {left}: it keeps most baseline structure but also adds extra nodes or edges."),
            (precision >= recall + 0.05, f"{right} is more conservative than {left}: it stays tighter, but it also misses more baseline structure."),
            ((recall >= 0.90) & (precision >= 0.90), f"{right} stays very close to {left} overall."),
            ((recall >= 0.75) & (precision >= 0.75), f"{right} is moderately close to {left}, with meaningful differences."),
        ],
        f"{right} differs substantially from {left}.",
    )


def score_hint(alignment: Column, recall: Column, precision: Column, left: str, right: str) -> Column:
    return chain(
        [
            (alignment >= 0.95, f"If your goal is to reproduce {left}, {right} performed very well."),
            (alignment >= 0.85, f"If your goal is to reproduce {left}, {right} performed reasonably well."),
            (recall > precision, f"{right} favors coverage over strict agreement with {left}."),
            (precision > recall, f"{right} favors strict agreement over full coverage of {left}."),
        ],
        f"{right} is not clearly better or worse without an external ground truth.",
    )


def condition_issues(condition: Column) -> Column:
    """array of unbalanced, many_parens (four in a row), malformed, duplicate_or_term."""
    c = F.coalesce(condition, F.lit(""))
    count = lambda ch: F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))
    terms = F.transform(F.split(F.upper(F.regexp_replace(c, "[()]", "")), r"\s+OR\s+"), collapse)
    return F.array_compact(
        F.array(
            F.when(count("(") != count(")"), "unbalanced"),
            F.when(c.rlike(r"\({4,}|\){4,}"), "many_parens"),
            F.when(c.rlike(r"(?i)\b(AND|OR|NOT)\s*\)|\(\s*(AND|OR)\b|\(\s*\)|^\s*(AND|OR)\b|\b(AND|OR|NOT)\s*$"), "malformed"),
            F.when(F.size(F.array_distinct(terms)) < F.size(terms), "duplicate_or_term"),
        )
    )
