"""Sinks: JSON lines, pretty JSON, one file an entity, Markdown tables and text scorecards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a report that is rendered on the driver, at most; larger results go to files of the executors.
MAX_REPORT_ROWS = 100_000


def json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object a line, in the executors' part files. Overwriting clears what earlier runs left."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def pretty_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One indented JSON object a row, an empty line between rows."""
    text = F.to_json(F.struct(*df.columns), {"pretty": "true", "ignoreNullFields": "false"})
    df.select(F.concat(text, F.lit("\n")).alias("value")).write.mode(mode).text(path)


def by_entity(df: DataFrame, path: str, *keys: str, mode: str = "overwrite") -> None:
    """A folder for each value of the keys. Rows of a value may come from several tasks, so a frequent one is no bottleneck."""
    df.write.mode(mode).partitionBy(*keys).json(path)


def _rows(df: DataFrame) -> list:
    rows = df.limit(MAX_REPORT_ROWS + 1).collect()
    if len(rows) > MAX_REPORT_ROWS:
        raise ValueError(f"a report of over {MAX_REPORT_ROWS} rows: write it with json_lines()")
    return rows


def _cell(value) -> str:
    if isinstance(value, bool):
        return "yes" if value else "no"
    if isinstance(value, list):
        return ", ".join(map(str, value)) or "none"
    return "" if value is None else str(value).replace("|", "\\|").replace("\n", " ")


def markdown(df: DataFrame, title: str | None = None) -> str:
    """A bounded result as a Markdown table."""
    lines = [f"# {title}", ""] if title else []
    lines += [f"| {' | '.join(df.columns)} |", "|" + "---|" * len(df.columns)]
    return "\n".join([*lines, *(f"| {' | '.join(map(_cell, r))} |" for r in _rows(df))]) + "\n"


def scorecard(df: DataFrame, title: str) -> str:
    """A bounded result as aligned 'name: value' lines."""
    width = max(map(len, df.columns))
    blocks = ["\n".join(f"{c:<{width}} : {_cell(v)}" for c, v in zip(df.columns, r, strict=True)) for r in _rows(df)]
    return "\n\n".join([f"{title}\n{'=' * len(title)}", *blocks]) + "\n"
