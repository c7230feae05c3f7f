"""Stable ids. SHA ids are built-in expressions; BLAKE2 and canonical JSON go through Arrow."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def joined_id(*parts: Column, sep: str = "||", length: int = 16) -> Column:
    """First hex digits of SHA-256 over the parts joined by sep; a null part counts as 'None'."""
    text = F.concat_ws(sep, *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts])
    return F.substring(F.sha2(text, 256), 1, length)


def content_hash(c: Column, length: int = 24) -> Column:
    return F.substring(F.sha2(c, 256), 1, length)


def text_sha1(c: Column, length: int = 40) -> Column:
    return F.substring(F.sha1(c.cast("binary")), 1, length)


def comment_id(program: Column, line: Column, kind: Column, text: Column) -> Column:
    digest = text_sha1(F.concat_ws("|", program, line.cast("string"), kind, text), 12)
    return F.concat(F.lit("program.comment."), program, F.lit("."), line.cast("string"), F.lit("."), digest)


@F.pandas_udf(T.StringType())
def short_blake(text: pd.Series) -> pd.Series:
    """16 hex digits of BLAKE2b."""
    return text.map(lambda t: None if t is None else hashlib.blake2b(t.encode(), digest_size=8).hexdigest())


@F.pandas_udf(T.StringType())
def canonical_json(text: pd.Series) -> pd.Series:
    """JSON with sorted keys, ', ' and ': ' between parts, and characters as they are; invalid JSON gives null."""

    def one(t):
        try:
            return None if t is None else json.dumps(json.loads(t), sort_keys=True, ensure_ascii=False)
        except ValueError:
            return None

    return text.map(one)


def document_id(kind: Column, title: Column, content_json: Column) -> Column:
    """Id of a document across programs: of its type, title and canonical content."""
    return joined_id(kind, title, canonical_json(content_json), sep="\n")
