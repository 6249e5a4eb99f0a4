"""Text cleaners (C1, C13, C14) as Column -> Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters a Java ``String.trim`` removes, U+0000 through U+0020.
JAVA_WHITESPACE = "".join(chr(code) for code in range(0x21))

# Fixed value: default cut length of the text cleaner.
DEFAULT_MAX_LEN = 200


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jtrim(c) -> Column:
    """Strip every char <= U+0020 from both ends (Spark ``trim`` strips spaces only)."""
    return F.btrim(_col(c), F.lit(JAVA_WHITESPACE))


def is_null_token(t: Column) -> Column:
    """True for the literal ``null`` in any letter case."""
    return F.lower(t) == F.lit("null")


def safe_str(c, max_len: int | None = DEFAULT_MAX_LEN) -> Column:
    """Trim; blank or any-case ``null`` -> null; cut to ``max_len`` code points."""
    return safe_str_of(jtrim(c), max_len)


def safe_str_of(t: Column, max_len: int | None = DEFAULT_MAX_LEN) -> Column:
    """:func:`safe_str` of text that is trimmed already."""
    kept = t if max_len is None else F.substring(t, 1, max_len)
    return F.when((t == F.lit("")) | is_null_token(t), F.lit(None).cast("string")).otherwise(kept)


def str_or_empty(c) -> Column:
    """Null or any-case ``null`` -> empty string, else trimmed text."""
    c = _col(c)
    return F.coalesce(F.when(~is_null_token(c), jtrim(c)), F.lit(""))


def cut(c, n: int) -> Column:
    """C14: keep at most ``n`` code points."""
    return F.substring(_col(c), 1, n)


def within_length(c, n: int) -> Column:
    """Q9 predicate: null or at most ``n`` code points."""
    c = _col(c)
    return c.isNull() | (F.length(c) <= F.lit(n))
