"""String functions as Column expressions. All stay in whole-stage code unless a docstring says Arrow."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixed

#: A run of white space, as Unicode-aware matching sees it, that is not one blank already: most blanks aren't matched at all.
SPACES = r"(?U) \s+|[\s&&[^ ]]\s*"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(fixed.WHITE))


def upper_name(c: Column) -> Column:
    """Trimmed, upper-cased; null gives ''."""
    return F.upper(strip(F.coalesce(c, F.lit(""))))


def upper_name_or_null(c: Column) -> Column:
    """Trimmed, upper-cased; null and blank give null."""
    return F.nullif(F.upper(strip(c)), F.lit(""))


def paragraph_name(c: Column) -> Column:
    """Upper-cased, without the full stops and then the commas at its end."""
    return F.rtrim(F.rtrim(F.upper(strip(c)), F.lit(".")), F.lit(","))


def collapse(c: Column) -> Column:
    """Trimmed, every run of white space one blank; null gives ''."""
    return strip(F.regexp_replace(F.coalesce(c, F.lit("")), SPACES, " "))


def compact_lines(c: Column) -> Column:
    """Each line collapsed; blank lines dropped."""
    return F.concat_ws("\n", F.filter(F.transform(F.split(c, r"\R"), collapse), lambda x: x != ""))


def safe_name(c: Column, allowed: str = "A-Z0-9-", default: str = "ITEM", upper: bool = True) -> Column:
    """A name for files: runs of characters outside ``allowed`` are one underscore, none at the ends."""
    base = F.upper(F.coalesce(c, F.lit(""))) if upper else strip(F.coalesce(c, F.lit("")))
    cleaned = F.btrim(F.regexp_replace(base, f"[^{allowed}]+", "_"), F.lit("_"))
    return F.when(cleaned == "", F.lit(default)).otherwise(cleaned)


def source_suffix(tag: Column, stem: Column) -> Column:
    """'.tag.stem' of whichever are not empty."""
    part = lambda c: safe_name(c, "A-Za-z0-9_-", "", upper=False)
    dotted = lambda c: F.when(part(c) == "", "").otherwise(F.concat(F.lit("."), part(c)))
    return F.concat(dotted(tag), dotted(stem))


def unquoted(c: Column) -> Column:
    """A statement without its quoted literals."""
    return F.regexp_replace(F.regexp_replace(c, "'[^']*'", " "), '"[^"]*"', " ")


def is_data_word(c: Column) -> Column:
    """False for the language's words; the monitor's names are data."""
    monitor = F.startswith(c, F.lit(fixed.MONITOR_PREFIXES[0])) | F.startswith(c, F.lit(fixed.MONITOR_PREFIXES[1]))
    return monitor | ~c.isin(*sorted(fixed.DATAFLOW_WORDS))


def identifiers(c: Column) -> Column:
    """Variables named in a statement, in order, repeats included."""
    found = F.regexp_extract_all(unquoted(F.upper(c)), F.lit(r"\b([A-Z][A-Z0-9-]*)\b"), 1)
    return F.filter(found, lambda t: (F.length(t) > 1) & is_data_word(t))


def flow_targets(c: Column) -> Column:
    """Distinct names that a statement performs, goes to, calls or links."""
    found = F.regexp_extract_all(F.upper(c), F.lit(r"\b(PERFORM|GO-TO|GOTO|CALL|LINK|XCTL)\s+([A-Z][A-Z0-9-]+)\b"), 2)
    words = sorted(fixed.DATAFLOW_WORDS)
    return F.array_distinct(F.filter(found, lambda t: ~t.isin(*words)))


def field_tokens(c: Column) -> Column:
    """Names in a statement that look like fields: with a hyphen or a known prefix."""
    found = F.regexp_extract_all(F.upper(c), F.lit(r"\b([A-Z][A-Z0-9-]+)\b"), 1)
    return F.array_distinct(F.filter(found, lambda t: F.contains(t, F.lit("-")) | t.rlike("^(W|PD|TWCOB|PX|DFH|SQL)")))


def structure_prefix(c: Column) -> Column:
    """What stands before the first hyphen."""
    return F.substring_index(F.upper(strip(F.coalesce(c, F.lit("")))), "-", 1)


def screen_family(c: Column) -> Column:
    """A screen field's name without its attribute letter."""
    return F.regexp_replace(F.upper(c), "^(.+)[AFILO]$", "$1")


def path_name(c: Column) -> Column:
    """The last part of a path, whichever slash it uses."""
    return F.regexp_extract(c, r"([^/\\]*)$", 1)


def path_stem(c: Column) -> Column:
    name = path_name(c)
    return F.when(name.rlike(r"^[^.]*\.[^.]*$|.\.[^.]*$"), F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")).otherwise(name)


def unquote_literal(c: Column) -> Column:
    """A literal without the quotes round it."""
    t = strip(c)
    first, last = F.substring(t, 1, 1), F.substring(t, -1, 1)
    quoted = (F.length(t) >= 2) & (first == last) & first.isin("'", '"')
    return F.when(quoted, F.substr(t, F.lit(2), F.length(t) - 2)).otherwise(t)


def ascii_arrows(c: Column) -> Column:
    """Arrows, also wrongly decoded ones, as ->."""
    return F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("â†’"), F.lit("->")), F.lit("→"), F.lit("->"))


def before_comma(c: Column) -> Column:
    return strip(F.substring_index(c, ",", 1))


def without_sequence(c: Column) -> Column:
    """A line without its six-digit sequence number."""
    return F.regexp_replace(c, "^[0-9]{6}", "")


def without_inline_comment(c: Column) -> Column:
    return F.when(F.contains(c, F.lit("*>")), F.rtrim(F.substring_index(c, "*>", 1))).otherwise(c)


def citation(path: Column, line: Column, detail: Column) -> Column:
    """'path | line N | detail'; missing parts are left out."""
    at = F.when(line.isNotNull() & (line != -1), F.concat(F.lit("line "), line.cast("string")))
    return F.concat_ws(" | ", path, at, F.nullif(detail, F.lit("")))


def percent(c: Column) -> Column:
    return F.concat(F.format_string("%.1f", c * 100), F.lit("%"))


def yes_no(c: Column) -> Column:
    return F.when(c, "yes").when(~c, "no").otherwise("unknown")


def list_or_none(c: Column) -> Column:
    return F.when(F.size(c) > 0, F.array_join(c, ", ")).otherwise("none")


def preview(items: Column, limit: int = 4) -> Column:
    """The first few items; how many more there are; 'none' for none."""
    held = F.filter(items, lambda x: x.isNotNull() & (x != ""))
    more = F.when(F.size(held) > limit, F.format_string(" (+%d more)", F.size(held) - limit)).otherwise("")
    return F.when(F.size(held) == 0, "none").otherwise(F.concat(F.array_join(F.slice(held, 1, limit), ", "), more))


def disposition(c: Column) -> Column:
    return F.upper(F.replace(F.coalesce(c, F.lit("")), F.lit(" "), F.lit("")))


def disposition_status(c: Column) -> Column:
    """The first status of a disposition, in brackets or not."""
    bare = F.regexp_replace(F.upper(strip(F.coalesce(c, F.lit("")))), r"^\((.*)\)$", "$1")
    return strip(F.substring_index(bare, ",", 1))


def commarea_prefix(c: Column) -> Column:
    """The field prefix that a call's parameter stands for."""
    table = F.create_map(*[F.lit(x) for pair in fixed.COMMAREA_FIELDS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.upper(c)), F.upper(c))


# Quote-aware splitting. A quoted stretch is one alternative of the pattern, so no state is needed.

_OUTSIDE = r"^((?:[^']|'[^']*(?:'|$))*?)"


def inline_note(c: Column) -> tuple[Column, Column]:
    """(text, note) cut at the first <== or ** outside quotes; the note is '' if there is none."""
    cut = F.regexp_extract(c, _OUTSIDE + r"(?:<==|\*\*)(.*)$", 1)
    there = c.rlike(_OUTSIDE + r"(?:<==|\*\*)")
    note = collapse(F.regexp_extract(c, _OUTSIDE + r"(?:<==|\*\*)(.*)$", 2))
    return F.rtrim(F.when(there, cut).otherwise(c)), F.when(there, note).otherwise("")


def continuation_note(c: Column) -> tuple[Column, Column]:
    """(text, note) cut at the first double blank outside quotes."""
    there = c.rlike(_OUTSIDE + "  ")
    note = collapse(F.regexp_extract(c, _OUTSIDE + "(  .*)$", 2))
    return F.rtrim(F.when(there, F.regexp_extract(c, _OUTSIDE + "  ", 1)).otherwise(c)), F.when(there, note).otherwise("")


_ITEM = r"((?:[^,()']|'[^']*(?:'|$)|\((?:[^()']|'[^']*'|\((?:[^()']|'[^']*'|\([^()]*\))*\))*(?:\)|$)|\))+)"


def top_level_items(c: Column) -> Column:
    """Operands between the commas outside brackets (three deep) and quotes; empty ones are dropped."""
    return F.filter(F.transform(F.regexp_extract_all(c, F.lit(_ITEM), 1), strip), lambda x: x != "")


def operands(c: Column) -> tuple[Column, Column]:
    """(positional operands, keyword operands as a map; the last of equal keys holds)."""
    items = top_level_items(c)
    positional = F.filter(items, lambda x: ~F.contains(x, F.lit("=")))
    pairs = F.transform(F.filter(items, lambda x: F.contains(x, F.lit("="))), lambda x: _pair(x))
    last = F.filter(pairs, lambda x, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda y: y["key"] == x["key"]))
    return positional, F.map_from_entries(last)


def _pair(x: Column) -> Column:
    value = strip(F.regexp_extract(x, "^[^=]*=(.*)$", 1))
    bare = F.when(value.rlike("^'.*'$"), value).otherwise(strip(F.regexp_replace(value, r"\s{2,}.*$", "")))
    return F.struct(F.upper(strip(F.substring_index(x, "=", 1))).alias("key"), bare.alias("value"))


@F.pandas_udf(T.StringType())
def decode_three(content: pd.Series) -> pd.Series:
    """UTF-8, else Windows-1252, else Latin-1 (Arrow: the JVM's decode() knows no Windows-1252)."""

    def one(b):
        for name in ("utf-8", "cp1252", "latin-1"):
            try:
                return None if b is None else bytes(b).decode(name)
            except UnicodeDecodeError:
                continue

    return content.map(one)
