"""Program text: fixed columns, logical statements, divisions, paragraphs, blocks and declarations."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import strip, without_inline_comment


def in_order(*, through: int = 0) -> Window:
    """Rows of a file up to the present one (through=-1: before it)."""
    return Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, through)


def fixed_columns(lines: DataFrame) -> DataFrame:
    """lines with indicator (column 7) and code (columns 8 to 72, right-trimmed)."""
    padded = F.rpad(F.coalesce("raw", F.lit("")), 80, " ")
    padded = F.when(F.length("raw") > 80, F.col("raw")).otherwise(padded)
    return lines.withColumn("indicator", F.substring(padded, 7, 1)).withColumn("code", F.rtrim(F.substring(padded, 8, 65)))


def statements(lines: DataFrame, comments: str = "*/", inline_comments: bool = True) -> DataFrame:
    """file, line_start, line_end, statement: lines joined with their continuations.

    ``comments`` are the indicators of lines that don't count (readers of debugging lines add D). Without
    ``inline_comments`` what follows *> is cut off.
    """
    rows = fixed_columns(lines).where(~F.col("indicator").isin(*comments))
    if not inline_comments:
        rows = rows.withColumn("code", without_inline_comment(F.col("code")))
    rows = rows.where("code <> ''").withColumn("part", F.sum(F.when(F.col("indicator") == "-", 0).otherwise(1)).over(in_order()))
    grouped = rows.groupBy("file", "part").agg(
        F.min("line_no").alias("line_start"), F.max("line_no").alias("line_end"), F.array_sort(F.collect_list(F.struct("line_no", "code"))).alias("held")
    )
    text = F.array_join(F.transform("held", lambda x: strip(x["code"])), " ")
    return grouped.select("file", "line_start", "line_end", strip(text).alias("statement"))


def procedure_statements(stmts: DataFrame, toggles: bool = True) -> DataFrame:
    """The statements inside PROCEDURE DIVISION: up to the next division, or (toggles=False) all after its header."""
    u = F.upper("statement")
    division = F.nullif(F.regexp_extract(u, fixed.DIVISION, 1), F.lit(""))
    if not toggles:
        division = F.when(division == "PROCEDURE", division)
    over = Window.partitionBy("file").orderBy("line_start").rowsBetween(Window.unboundedPreceding, 0)
    marked = stmts.withColumn("is_header", division.isNotNull()).withColumn("division", F.last(division, ignorenulls=True).over(over))
    return marked.where("division = 'PROCEDURE' AND NOT is_header").drop("division", "is_header")


def with_paragraphs(stmts: DataFrame, seed: Column, words: frozenset = fixed.DATAFLOW_WORDS, drop_words: bool = True) -> DataFrame:
    """stmts with their paragraph filled forward (``seed`` before the first); label statements are dropped.

    A label that is one of the language's words is no paragraph: dropped too, or (drop_words=False) kept as a statement.
    """
    name = F.nullif(F.regexp_extract(F.upper("statement"), fixed.PARAGRAPH, 1), F.lit(""))
    label = F.when(~name.isin(*sorted(words)), name)
    over = Window.partitionBy("file").orderBy("line_start").rowsBetween(Window.unboundedPreceding, 0)
    filled = stmts.withColumn("paragraph", F.coalesce(F.last(label, ignorenulls=True).over(over), seed))
    return filled.where((name if drop_words else label).isNull())


def paragraph_order(stmts: DataFrame, programs: DataFrame, words: frozenset = fixed.FLOW_WORDS) -> DataFrame:
    """file, paragraph, ord: the program itself (0), then its paragraphs in source order, each once."""
    name = F.nullif(F.regexp_extract(F.upper("statement"), fixed.PARAGRAPH, 1), F.lit(""))
    labels = stmts.select("file", name.alias("paragraph"), "line_start").where(F.col("paragraph").isNotNull() & ~F.col("paragraph").isin(*sorted(words)))
    first = labels.groupBy("file", "paragraph").agg(F.min("line_start").alias("at"))
    top = programs.select("file", F.col("program").alias("paragraph"), F.lit(0).alias("at"))
    every = top.unionByName(first).groupBy("file", "paragraph").agg(F.min("at").alias("at"))
    return every.select("file", "paragraph", (F.row_number().over(Window.partitionBy("file").orderBy("at")) - 1).alias("ord"))


def raw_paragraph_lines(lines: DataFrame, programs: DataFrame) -> DataFrame:
    """file, program, line_no, paragraph, raw of the uncommented lines after PROCEDURE DIVISION (of all, if there is none).

    Here any single word with a full stop opens a paragraph, and columns don't count: the reader of edges and conditions.
    """
    header = F.when(F.upper("raw").rlike(r"^\s*PROCEDURE\s+DIVISION\.\s*$"), F.col("line_no"))
    start = F.coalesce(F.min(header).over(Window.partitionBy("file")), F.lit(0))
    body = lines.join(programs, "file").withColumn("start", start).where("line_no > start").where(~strip(F.col("raw")).startswith("*"))
    label = F.nullif(F.upper(F.regexp_extract("raw", r"(?i)^\s*([A-Z0-9-]+)\s*\.\s*$", 1)), F.lit(""))
    filled = body.withColumn("paragraph", F.coalesce(F.last(label, ignorenulls=True).over(in_order()), "program")).where(label.isNull())
    return filled.select("file", "program", "line_no", "paragraph", F.rtrim("raw").alias("raw"))


def raw_paragraph_order(lines: DataFrame, programs: DataFrame) -> DataFrame:
    """file, paragraph, ord as raw_paragraph_lines() sees them."""
    header = F.when(F.upper("raw").rlike(r"^\s*PROCEDURE\s+DIVISION\.\s*$"), F.col("line_no"))
    start = F.coalesce(F.min(header).over(Window.partitionBy("file")), F.lit(0))
    body = lines.withColumn("start", start).where("line_no > start").where(~strip(F.col("raw")).startswith("*"))
    label = F.nullif(F.upper(F.regexp_extract("raw", r"(?i)^\s*([A-Z0-9-]+)\s*\.\s*$", 1)), F.lit(""))
    labels = body.select("file", label.alias("paragraph"), F.col("line_no").alias("at")).where("paragraph IS NOT NULL")
    top = programs.select("file", F.col("program").alias("paragraph"), F.lit(0).alias("at"))
    every = top.unionByName(labels).groupBy("file", "paragraph").agg(F.min("at").alias("at"))
    return every.select("file", "paragraph", (F.row_number().over(Window.partitionBy("file").orderBy("at")) - 1).alias("ord"))


def monitor_blocks(lines: DataFrame, code: str = "code", by: tuple[str, ...] = ("file",)) -> DataFrame:
    """by, line_start, line_end, statement: EXEC CICS ... END-EXEC blocks, which may run over lines.

    Between two ends a block opens at the first EXEC; unfinished blocks are dropped. Two windows, no fold.
    """
    u = F.upper(code)
    order = Window.partitionBy(*by).orderBy("line_no")
    rows = lines.where(F.col(code) != "").withColumn("ends", F.when(F.contains(u, F.lit("END-EXEC")), 1).otherwise(0))
    rows = rows.withColumn("part", F.coalesce(F.sum("ends").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    opens = F.min(F.when(F.contains(u, F.lit("EXEC CICS")), F.col("line_no"))).over(Window.partitionBy(*by, "part"))
    inside = rows.withColumn("opens", opens).where("line_no >= opens")
    blocks = inside.groupBy(*by, "part").agg(
        F.min("line_no").alias("line_start"), F.max("line_no").alias("line_end"), F.max("ends").alias("ends"),
        F.array_sort(F.collect_list(F.struct("line_no", F.col(code).alias("code")))).alias("held"),
    )
    return blocks.where("ends = 1").select(*by, "line_start", "line_end", F.array_join(F.transform("held", lambda x: x["code"]), " ").alias("statement"))


_CALL = re.compile(r"\bCALL\s+('[^']+'|\"[^\"]+\"|[A-Z0-9-]+)\s+USING\b", re.I)
_LABEL = re.compile(r"\s*([A-Z0-9][A-Z0-9-]*)\.\s*")


def terminated_statements(lines: DataFrame) -> DataFrame:
    """file, paragraph, line_start, line_end, statement: text gathered up to its full stop, END-EXEC or CALL ... USING.

    Whether a line ends a statement depends on all that the statement holds so far, so each file is folded
    in order (Arrow, one file at a time).
    """

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        out, held, start, last, paragraph = [], [], 0, 0, ""
        for at, raw in rows.sort_values("line_no")[["line_no", "raw"]].itertuples(index=False):
            text = (raw or "").strip()
            label = _LABEL.fullmatch(raw or "")
            if text[:1] in ("*", "/"):
                continue
            if label and label[1].upper() not in fixed.NOT_PARAGRAPHS:
                paragraph = label[1]
                continue
            if not text or re.fullmatch(r"SKIP\d*|EJECT", text, re.I):
                continue
            start = at if not held else start
            held.append(text)
            last = at
            whole = " ".join(held)
            upper = whole.upper()
            done = "END-EXEC" in upper if "EXEC CICS" in upper else bool(_CALL.search(whole)) or whole.endswith(".")
            if done:
                out.append((rows["file"].iloc[0], paragraph, start, last, " ".join(whole.split())))
                held = []
        return pd.DataFrame(out, columns=["file", "paragraph", "line_start", "line_end", "statement"])

    return lines.groupBy("file").applyInPandas(fold, "file string, paragraph string, line_start int, line_end int, statement string")


def declarations(stmts: DataFrame) -> DataFrame:
    """file, variable, origin of the fields declared in DATA DIVISION, the first declaration of each.

    Division, section and the present 01 level are filled forward; fields below a commarea record of LINKAGE are COMMAREA.
    """
    u = F.upper("statement")
    over = Window.partitionBy("file").orderBy("line_start").rowsBetween(Window.unboundedPreceding, 0)
    division = F.nullif(F.regexp_extract(u, fixed.DIVISION, 1), F.lit(""))
    section = F.nullif(F.regexp_extract(u, r"^\s*([A-Z0-9-]+)\s+SECTION\.\s*$", 1), F.lit(""))
    level, name = F.regexp_extract(u, r"^\s*([0-9]{2})\s+([A-Z][A-Z0-9-]+)\b", 1), F.regexp_extract(u, r"^\s*([0-9]{2})\s+([A-Z][A-Z0-9-]+)\b", 2)
    rows = stmts.select("file", "line_start", division.alias("d"), section.alias("s"), level.alias("level"), name.alias("variable"))
    rows = rows.withColumn("division", F.last("d", ignorenulls=True).over(over))
    # A division header clears the section; a section header clears the record.
    rows = rows.withColumn("section", F.nullif(F.last(F.when(F.col("d").isNotNull(), "").otherwise(F.col("s")), ignorenulls=True).over(over), F.lit("")))
    linkage = (F.col("section") == "LINKAGE") & F.col("variable").isin("DFHCOMMAREA", "COMMAREA", "LK-COMMAREA")
    record = F.when(F.col("d").isNotNull() | F.col("s").isNotNull(), F.lit(False)).when(F.col("level") == "01", F.coalesce(linkage, F.lit(False)))
    rows = rows.withColumn("commarea", F.coalesce(F.last(record, ignorenulls=True).over(over), F.lit(False)))
    rows = rows.where("division = 'DATA' AND variable <> '' AND d IS NULL AND s IS NULL")
    origin = (
        F.when(F.col("section") == "LINKAGE", F.when(F.col("commarea"), "COMMAREA").otherwise("LINKAGE")).otherwise(F.coalesce("section", F.lit("UNKNOWN")))
    )
    return first_declarations(rows.select("file", "line_start", "variable", origin.alias("origin")))


def copybook_declarations(stmts: DataFrame, stem: Column) -> DataFrame:
    """file, variable, origin (COPY:stem) of the fields that copybooks declare."""
    name = F.regexp_extract(F.upper("statement"), r"^\s*([0-9]{2})\s+([A-Z][A-Z0-9-]+)\b", 2)
    rows = stmts.select("file", "line_start", name.alias("variable"), F.concat(F.lit("COPY:"), F.upper(stem)).alias("origin")).where("variable <> ''")
    return first_declarations(rows)


def first_declarations(rows: DataFrame) -> DataFrame:
    from ..functions.text import is_data_word

    monitor = F.when(F.startswith("variable", F.lit("DFH")), "CICS_CONST").when(F.startswith("variable", F.lit("EIB")), "CICS_EIB")
    known = rows.where(is_data_word(F.col("variable"))).withColumn("origin", F.coalesce(monitor, "origin"))
    rank = F.struct((F.col("origin") == "UNKNOWN").alias("u"), F.col("line_start").alias("at"))
    return known.groupBy("file", "variable").agg(F.min_by("origin", rank).alias("origin"))


def copy_references(lines: DataFrame) -> DataFrame:
    """file, copybook: what COPY names, without the system's own copybooks."""
    name = F.upper(F.regexp_extract("raw", r"""(?i)^\s*(?!\*)\s*(?:[A-Z0-9-]+\s+)?COPY\s+['"]?([A-Z0-9_-]+)['"]?""", 1))
    found = lines.select("file", name.alias("copybook")).where((F.col("copybook") != "") & ~F.col("copybook").isin(*fixed.SYSTEM_COPYBOOKS))
    return found.distinct()


def comments(lines: DataFrame) -> DataFrame:
    """file, line_no, section, paragraph, in_procedure, kind (full_line or inline), text_raw, text of the comments with words."""
    from ..functions.classify import is_noise
    from ..functions.text import collapse

    u = F.upper("code")
    rows = fixed_columns(lines)
    header = u.rlike(r"^\s*PROCEDURE\s+DIVISION\.\s*$")
    rows = rows.withColumn("in_procedure", F.coalesce(F.max(header).over(in_order()), F.lit(False)))
    section = F.nullif(F.regexp_extract(u, r"^\s*([A-Z0-9-]+)\s+SECTION\.\s*$", 1), F.lit(""))
    label = F.when(F.col("in_procedure"), F.nullif(F.regexp_extract(u, fixed.PARAGRAPH, 1), F.lit("")))
    # Section and division headers close the paragraph.
    mark = F.coalesce(label, F.when(header | section.isNotNull(), F.lit("")))
    rows = rows.withColumn("section", F.last(section, ignorenulls=True).over(in_order()))
    rows = rows.withColumn("paragraph", F.nullif(F.last(mark, ignorenulls=True).over(in_order()), F.lit("")))
    whole, inline = F.col("indicator").isin("*", "/"), F.contains("code", F.lit("*>"))
    text_raw = F.when(whole, strip(F.col("code"))).when(inline, strip(F.regexp_extract("code", r"\*>(.*)$", 1)))
    rows = rows.withColumn("kind", F.when(whole, "full_line").when(inline, "inline")).withColumn("text_raw", text_raw).where("kind IS NOT NULL")
    rows = rows.withColumn("text", collapse(F.col("text_raw"))).where(~is_noise(F.col("text")))
    return rows.select("file", "line_no", "section", "paragraph", "in_procedure", "kind", "text_raw", "text")
