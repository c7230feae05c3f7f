"""Static-analysis records: comma-separated lines of many record types, typed, with their program filled forward.

Every fact is a table of its own keyed by program. Lists are ordered by line only where a document needs it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import path_stem, strip, upper_name

HANDLED = ("FILE", "COPY", "SQLINCLUDE", "PGM", "CALL", "UNRESOLVEDCALL", "DB2TABLE")


def fields(c: Column) -> Column:
    """Fields of a comma-separated line; quoted ones may hold commas and doubled quotes; blanks before a field are dropped."""
    found = F.regexp_extract_all(F.concat(strip(c), F.lit(",")), F.lit(r'[ ]*("(?:[^"]|"")*"[^,]*|[^,]*),'), 1)
    plain = lambda x: F.replace(F.regexp_extract(x, r'^"((?:[^"]|"")*)"', 1), F.lit('""'), F.lit('"'))
    return F.transform(found, lambda x: F.when(x.rlike('^"(?:[^"]|"")*"'), F.concat(plain(x), F.regexp_extract(x, r'^"(?:[^"]|"")*"(.*)$', 1))).otherwise(x))


def records(lines: DataFrame) -> DataFrame:
    """file, line_no, program, rec, parts, line of every record.

    A FILE record names the program of the lines after it; lines before any belong to UNKNOWN. One window over
    each file: a file of records is read by one task, as its order is its meaning.
    """
    parts = lines.select("file", "line_no", strip(F.col("raw")).alias("line"), fields(F.col("raw")).alias("parts")).where("line <> ''")
    parts = parts.withColumn("rec", F.upper(strip(F.get("parts", F.lit(0))))).where("rec <> ''")
    path = F.get("parts", F.lit(2))
    named = F.when(F.col("rec") == "FILE", upper_name(F.when(F.coalesce(path, F.lit("")) == "", "UNKNOWN").otherwise(path_stem(path))))
    order = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    program = F.coalesce(F.last(named, ignorenulls=True).over(order), F.lit("UNKNOWN"))
    return parts.select("file", "line_no", program.alias("program"), "rec", "parts", "line")


def _last(n: int = 1) -> Column:
    return upper_name(F.try_element_at("parts", F.lit(-n)))


def _first_seen(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys with the line that brought each first: a partial aggregate, then one shuffle."""
    return df.groupBy(*keys).agg(F.min("line_no").alias("line_no"))


def copybooks(recs: DataFrame) -> DataFrame:
    """program, name, line_no."""
    return _first_seen(recs.where("rec = 'COPY'").withColumn("name", _last()).where("name <> ''"), ["program", "name"])


def sql_includes(recs: DataFrame) -> DataFrame:
    """program, name, line_no."""
    return _first_seen(recs.where("rec = 'SQLINCLUDE'").withColumn("name", _last()).where("name <> ''"), ["program", "name"])


def calls(recs: DataFrame, resolved: bool = True) -> DataFrame:
    """program, call_type, target, line_no; unresolved ones on request."""
    rec = "CALL" if resolved else "UNRESOLVEDCALL"
    own = recs.where((F.col("rec") == rec) & (F.size("parts") >= 6)).withColumn("call_type", _last(2)).withColumn("target", _last())
    return _first_seen(own.where("call_type <> '' AND target <> ''"), ["program", "call_type", "target"])


def tables(recs: DataFrame) -> DataFrame:
    """program, table, stmt_type, line_no."""
    whole = F.size("parts") >= 5
    own = recs.where("rec = 'DB2TABLE'").select(
        "program",
        "line_no",
        F.when(whole, upper_name(F.get("parts", F.lit(3)))).otherwise(_last(2)).alias("table"),
        strip(F.when(whole, F.get("parts", F.lit(4))).otherwise(F.element_at("parts", -1))).alias("stmt_type"),
    )
    return _first_seen(own.where("table <> ''"), ["program", "table", "stmt_type"])


def resources(recs: DataFrame) -> DataFrame:
    """program, operation, resource, line_no of the monitor's records."""
    own = recs.where(F.startswith("rec", F.lit("CICS")) & (F.size("parts") >= 2)).withColumn("resource", _last()).withColumnRenamed("rec", "operation")
    return _first_seen(own.where("resource <> ''"), ["program", "operation", "resource"])


def metrics(recs: DataFrame) -> DataFrame:
    """program, file_path, file_timestamp, loc, statements, paragraphs: the last record of each kind holds."""
    number = lambda i: F.try_to_number(F.get("parts", F.lit(i)), F.lit("9999999999")).cast("int")
    at = F.struct("file", "line_no")
    is_file, is_program = F.col("rec") == "FILE", F.col("rec") == "PGM"
    last = lambda value, mine: F.max_by(value, F.when(mine, at))
    return recs.groupBy("program").agg(
        last(F.get("parts", F.lit(2)), is_file).alias("file_path"),
        last(F.get("parts", F.lit(3)), is_file).alias("file_timestamp"),
        last(number(4), is_program & (F.size("parts") > 4)).alias("loc"),
        last(number(5), is_program & (F.size("parts") > 5)).alias("statements"),
        last(number(6), is_program & (F.size("parts") > 6)).alias("paragraphs"),
    )


def unhandled(recs: DataFrame, examples: int = 3) -> DataFrame:
    """program, rec, n, examples: record types without a table, with their first lines."""
    other = recs.where(~F.col("rec").isin(*HANDLED) & ~F.startswith("rec", F.lit("CICS")))
    nth = F.row_number().over(Window.partitionBy("program", "rec").orderBy("file", "line_no"))
    first = F.when(F.col("nth") <= examples, F.struct("file", "line_no", "line"))
    grouped = other.withColumn("nth", nth).groupBy("program", "rec").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(first)).alias("held"))
    return grouped.select("program", "rec", "n", F.transform("held", lambda x: x["line"]).alias("examples"))
