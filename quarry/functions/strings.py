"""String column functions (all JVM-side expressions, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line breaks recognised when a text column holds many lines.
LINE_BREAK_PATTERN = r"\r\n|\r|\n"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_lines(text: str | Column) -> Column:
    """Array of the lines of a text column.

    A final line break yields a trailing empty line (unlike a text *file*
    read, which emits no row for the empty tail).
    """
    return F.split(_col(text), LINE_BREAK_PATTERN, -1)


def java_split_spaces(line: str | Column) -> Column:
    """Tokens of ``line`` split on single spaces, with the JVM ``String.split``
    rules: inner and leading empty tokens are kept, trailing empty tokens are
    dropped, an empty line gives ``[""]`` and an all-space line gives ``[]``.
    """
    line = _col(line)
    trimmed = F.rtrim(line)  # spaces only
    return (
        F.when(line == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, " ", -1))
    )


def parse_double(c: str | Column, strict: bool = True) -> Column:
    """Text to double.  ``strict`` fails on bad text, whatever the session's
    ANSI setting; otherwise bad text becomes null."""
    c = _col(c)
    value = c.try_cast("double")
    if not strict:
        return value
    bad = F.raise_error(F.concat(F.lit("not a number: "), c.cast("string"))).cast("double")
    return F.when(c.isNotNull(), F.coalesce(value, bad))
