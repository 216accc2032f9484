"""Text, JSON and collation helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Compares without regard to case and accents.
LOOSE = "UNICODE_CI_AI"


def loose(column: Column) -> Column:
    """The column under a collation that ignores case and accents (emails, slugs)."""
    return F.collate(column, LOOSE)


def clean_email(column: Column) -> Column:
    return F.lower(F.trim(column))


def masked_email(column: Column) -> Column:
    """First letter and domain only."""
    return F.regexp_replace(column, "^(.)[^@]*(@.*)$", "$1***$2")


def json_text(document: Column, path: str) -> Column:
    return F.get_json_object(document, path)


def json_object(*columns: Column) -> Column:
    """JSON object that keeps keys whose value is NULL."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def lenient_number(column: Column, kind: str = "long") -> Column:
    """NULL instead of an error for text that is no number."""
    return column.try_cast(kind)


# Quoted text, hexadecimal and decimal numbers that are no part of a name.
LITERALS = (
    r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\""
    r"|(?<![\w.])(?:0x[0-9a-fA-F]+|-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)\b"
)


def statement_digest(sql: Column) -> Column:
    """A statement with its literals replaced by ``?`` and its blanks squeezed."""
    shape = F.regexp_replace(F.regexp_replace(sql, LITERALS, "?"), r"\s+", " ")
    shape = F.regexp_replace(shape, r"\( ?\?(?: ?, ?\?)+ ?\)", "(?)")
    return F.lower(F.ltrim(F.rtrim(shape, F.lit("; "))))
