"""Numeric cleaners (C2, C3, C9, C10, C12, C15, C16) as Column -> Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedworks.functions.text import _col, jtrim

# 32-bit integer bounds used for saturation.
INT_MAX = 2147483647
INT_MIN = -2147483648

# The text shapes Java's parsers accept.  ``Integer.parseInt``: an
# optional sign and digits.  ``Double.parseDouble``: an optional sign, then "NaN",
# "Infinity", a decimal with optional exponent, or a hexadecimal significand with a
# binary exponent; decimal and hex forms may end in d, D, f or F.
INT_TEXT = r"^[+-]?[0-9]+$"
DOUBLE_TEXT = (r"^[+-]?(NaN|Infinity|(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
               r"|0[xX]([0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+)[fFdD]?)$")

# Spark's string -> double cast is ``Double.parseDouble`` itself, plus any-case
# "nan" / "inf" words (which the shape above excludes).  Casting only text of an
# accepted shape means a cast never fails: a failed cast raises inside the JVM (tens
# of microseconds per value), a regex test costs a fraction of that.


def double_to_int(d) -> Column:
    """Java ``(int) double``: truncate toward zero, saturate, NaN -> 0, null -> null."""
    d = _col(d)
    clamped = F.greatest(F.least(d, F.lit(float(INT_MAX))), F.lit(float(INT_MIN)))
    return (F.when(d.isNull(), F.lit(None).cast("int"))
            .when(F.isnan(d), F.lit(0))
            .otherwise(clamped.cast("int")))


def parse_double(t: Column) -> Column:
    """Java ``Double.parseDouble`` on already-trimmed text, null when it would throw."""
    return F.when(t.rlike(DOUBLE_TEXT), t.try_cast("double"))


def int_from(t: Column, d: Column) -> Column:
    """C2 given the trimmed text ``t`` and its Java double ``d``."""
    clamped = F.greatest(F.least(d, F.lit(float(INT_MAX))), F.lit(float(INT_MIN)))
    return (F.when(d.isNull(), F.lit(None).cast("int"))
            .when(t.contains("."), F.when(F.isnan(d), F.lit(0)).otherwise(clamped.cast("int")))
            .when(t.rlike(INT_TEXT) & d.between(F.lit(float(INT_MIN)), F.lit(float(INT_MAX))),
                  d.cast("int")))


def strict_int_from(t: Column, d: Column) -> Column:
    """Java ``Integer.parseInt`` given the trimmed text and its Java double."""
    return F.when(t.rlike(INT_TEXT) & d.between(F.lit(float(INT_MIN)), F.lit(float(INT_MAX))),
                  d.cast("int"))


def parse_int(t: Column) -> Column:
    """Java ``Integer.parseInt`` on already-trimmed text, null when it would throw.

    Digit strings are read through the double parse: exact for every value in the
    32-bit range; out-of-range values fail the bounds test.
    """
    return strict_int_from(t, parse_double(t))


def safe_int(c) -> Column:
    """Strict int of the trimmed text; else, only if it has a '.', a double
    truncated toward zero with saturation; else null.

    As one expression the parse is repeated in the CASE branches; DataFrame code
    cleaning many cells should use :func:`feedworks.functions.staged.clean_columns`,
    which trims and parses each cell once.
    """
    t = jtrim(c)
    return int_from(t, parse_double(t))


def safe_double(c) -> Column:
    """Double of the trimmed text, null when blank or malformed."""
    return parse_double(jtrim(c))


def to_int_half_even(d) -> Column:
    """Store a double in an INTEGER column: round half to even, overflow / NaN -> null."""
    return F.bround(_col(d), 0).try_cast("int")


def to_decimal(d, precision: int = 3, scale: int = 1) -> Column:
    """Store a double in NUMERIC(p, s): round half away from zero, overflow -> null."""
    return _col(d).try_cast(f"decimal({precision},{scale})")


def int_or_zero(c) -> Column:
    """Strict int of the trimmed text, anything else 0."""
    return F.coalesce(parse_int(jtrim(c)), F.lit(0))


def decade(c) -> Column:
    """``(v / 10) * 10`` in integer arithmetic (truncates toward zero).

    ``v - v % 10`` is the same value: Spark's ``%`` takes the sign of the dividend,
    like Java's, so -15 -> -10 and 27 -> 20.
    """
    v = _col(c).cast("int")
    return (v - v % F.lit(10)).cast("int")


def decade_label(c) -> Column:
    """Band label such as ``20-29`` for the decade of ``c``."""
    d = decade(c)
    return F.concat(d.cast("string"), F.lit("-"), (d + F.lit(9)).cast("string"))


def round2(c) -> Column:
    """Two-decimal value of an average (kept numeric)."""
    return F.round(_col(c), 2)
