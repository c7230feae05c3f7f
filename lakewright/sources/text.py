"""Text sources: files as rows, decoded, and their lines. Columns: file, line_no (from 1), raw."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import decode_three, path_name, path_stem, strip

#: Line ends as a text reader of whole files sees them.
LINE_ENDS = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\u0085  ]"

# --- fixed values: which folders hold which language
SOURCE_KINDS = [("cobol", "cobol", (".cbl", ".cob", ".cobol")), ("copybooks", "copybook", (".cpy", ".copy")), ("bms", "bms", (".bms",)), ("jcl", "jcl", (".jcl",))]


def decoded(content: Column, fallback: str | None = None) -> Column:
    """Text of bytes. fallback None: bytes that aren't UTF-8 are replaced; 'latin': the whole as Latin-1; 'windows': as Windows-1252, else Latin-1."""
    if fallback is None:
        return F.make_valid_utf8(content.cast("string"))
    if fallback == "latin":
        return F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(F.decode(content, "ISO-8859-1"))
    if fallback == "windows":
        return decode_three(content)
    raise ValueError(fallback)


def any_case(extension: str) -> str:
    """A glob for an extension in any case."""
    return "*" + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in extension)


def read_files(spark: SparkSession, path: str, extensions: tuple[str, ...] = (), fallback: str | None = None, recursive: bool = True) -> DataFrame:
    """file, text of the files below a folder of any store that Spark reads; each path once, whatever its case.

    Whole files are rows: they are programs and job scripts, small by nature. Only names are shuffled for the
    deduplication; contents are read after it.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if extensions:
        reader = reader.option("pathGlobFilter", "{" + ",".join(any_case(e) for e in extensions) + "}")
    files = reader.load(path)
    first = files.select("path").groupBy(F.lower("path").alias("key")).agg(F.min("path").alias("path")).select("path")
    return files.join(first, "path", "left_semi").select(F.col("path").alias("file"), decoded(F.col("content"), fallback).alias("text"))


def lines(files: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """file, line_no, raw of every line; a line end at the end of a file opens no line. Empty files have none."""
    # A column of its own: inside the explode each use would split the text again.
    held = files.select(F.col(file).alias("file"), F.split(F.coalesce(F.col(text), F.lit("")), LINE_ENDS).alias("__parts"))
    parts = F.col("__parts")
    parts = F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    return held.select("file", F.posexplode(parts).alias("line_no", "raw")).withColumn("line_no", F.col("line_no") + 1)


def source_kind(files: DataFrame, kinds=SOURCE_KINDS) -> DataFrame:
    """files with runtime and kind by folder and extension; files of no kind are dropped (a broadcast join: the table is given, not data)."""
    rows = [(folder, kind, ext) for folder, kind, exts in kinds for ext in exts]
    table = files.sparkSession.createDataFrame(rows, "folder string, kind string, ext string")
    named = files.withColumn("ext", F.lower(F.regexp_extract(path_name(F.col("file")), r"(\.[^.]*)$", 1)))
    return named.join(F.broadcast(table), "ext").drop("ext")


def program_names(lines_: DataFrame, pattern: str = r"(?i)PROGRAM-ID\.\s*([A-Z0-9-]+)", default: Column | None = None) -> DataFrame:
    """file, program: of the first line with a program name, else the upper-cased stem of the file (or ``default``).

    Stricter readers pass a pattern that ends with a full stop.
    """
    found = F.nullif(F.upper(F.regexp_extract("raw", pattern, 1)), F.lit(""))
    first = F.min_by(found, F.when(found.isNotNull(), F.col("line_no")))
    name = F.coalesce("named", default if default is not None else F.upper(path_stem(F.col("file"))))
    return lines_.groupBy("file").agg(first.alias("named")).select("file", name.alias("program"))


def report_stems(texts: DataFrame, text: str = "text") -> DataFrame:
    """stem: distinct names of JSON files that a report mentions, upper-cased."""
    names = F.regexp_extract_all(F.col(text), F.lit(r"(?i)([A-Z0-9_$#@-]+)\.json"), 1)
    return texts.select(F.explode(F.array_distinct(F.transform(names, F.upper))).alias("stem")).distinct()


def summary_sections(lines_: DataFrame, headers: dict[str, str]) -> DataFrame:
    """file, section, line_no, entry: the '-' entries below each header line of a summary."""
    u = F.upper(strip(F.col("raw")))
    opened = F.lit(None).cast("string")
    for header, section in headers.items():
        opened = F.coalesce(opened, F.when(F.startswith(u, F.lit(header.upper())), section))
    order = Window.partitionBy("file").orderBy("line_no")
    filled = lines_.withColumn("section", F.last(opened, ignorenulls=True).over(order)).withColumn("opens", opened.isNotNull())
    entry = F.regexp_extract(strip(F.col("raw")), r"^-\s*(.+)$", 1)
    return filled.where(~F.col("opens") & F.col("section").isNotNull() & (entry != "")).select("file", "section", "line_no", entry.alias("entry"))
