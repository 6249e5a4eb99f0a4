"""Clean many text cells of a DataFrame with each cell trimmed and parsed once.

A cleaner written as one Column expression repeats its parse inside CASE branches
(Spark shares a subexpression only when it is evaluated unconditionally more than
once).  ``clean_columns`` instead projects in stages: trimmed text, then the cast,
then the typed value computed from those columns.  Catalyst keeps the stages apart
because collapsing them would duplicate non-trivial expressions, so every cell is
trimmed once and cast at most once.  All stages are narrow: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedworks.functions import lists, numeric, temporal, text

# kind -> final expression from (text, trimmed, parsed double); "str" needs the trimmed text only
NUMERIC_KINDS = {
    "int": lambda src, t, d: numeric.int_from(t, d),                       # C2
    "int_or_zero": lambda src, t, d: F.coalesce(numeric.strict_int_from(t, d), F.lit(0)),  # C12
    "double": lambda src, t, d: d,                                          # C3
    "int_half_even": lambda src, t, d: numeric.to_int_half_even(d),         # C3 + C9
    "decimal_3_1": lambda src, t, d: numeric.to_decimal(d, 3, 1),           # C3 + C10
}
OTHER_KINDS = {
    "date": lambda src: temporal.parse_date(src),                           # C4 + C11
    "list": lambda src: lists.normalize_list(src),                          # C5 / X7
}


def worked_out(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns``, each computed once for a row, whatever is filtered on them later.

    Catalyst copies the expressions of a projection into every filter on them, with all that
    they are made of; a chain of stages then is computed anew at each of its uses, in one
    method too large to be compiled.  It does not look into the rows that ``inline``
    makes: filters on these columns stay above."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def clean_columns(df: DataFrame, specs: list[tuple[str, str, str]],
                  keep: list[str] = (), raw_doubles: bool = False,
                  max_len: int | None = text.DEFAULT_MAX_LEN, cut_flags: bool = False) -> DataFrame:
    """Typed projection of ``df``.

    ``specs`` lists ``(output, kind, source column)``; kinds are the keys of
    ``NUMERIC_KINDS`` and ``OTHER_KINDS``.  ``keep`` columns pass through unchanged.
    With ``raw_doubles`` the parsed double of every numeric source is also returned
    as ``_raw_<output>`` (used by the fits-the-target rule, Q15).  Text is cut to ``max_len``
    (None: not at all); with ``cut_flags`` a boolean ``_cut_<output>`` tells which cells
    were.
    """
    passthrough = [k for k in keep if isinstance(k, str)]
    num = [(o, k, s) for o, k, s in specs if k in NUMERIC_KINDS]
    staged = dict.fromkeys(s for _, k, s in specs if k in NUMERIC_KINDS or k == "str")
    trimmed = {s: f"_t_{i}" for i, s in enumerate(staged)}
    parsed = {s: f"_d_{i}" for i, s in enumerate(dict.fromkeys(s for _, _, s in num))}
    srcs = list(dict.fromkeys([s for _, _, s in specs] + passthrough))
    s1 = df.select(*[F.col(s) for s in srcs],
                   *[text.jtrim(s).alias(t) for s, t in trimmed.items()])
    s2 = s1.select("*", *[numeric.parse_double(F.col(trimmed[s])).alias(d) for s, d in parsed.items()])
    out = []
    for o, k, s in specs:
        if k in NUMERIC_KINDS:
            out.append(NUMERIC_KINDS[k](F.col(s), F.col(trimmed[s]), F.col(parsed[s])).alias(o))
        elif k == "str":
            out.append(text.safe_str_of(F.col(trimmed[s]), max_len).alias(o))                   # C1
        elif k in OTHER_KINDS:
            out.append(OTHER_KINDS[k](F.col(s)).alias(o))
        elif k == "raw":
            out.append(F.col(s).alias(o))
        else:
            raise ValueError(f"unknown kind {k!r} for {o}")
    if raw_doubles:
        out += [F.col(parsed[s]).alias(f"_raw_{o}") for o, k, s in num]
    if cut_flags and max_len is not None:
        out += [(F.length(trimmed[s]) > max_len).alias(f"_cut_{o}") for o, k, s in specs if k == "str"]
    return s2.select(*out, *[F.col(k) for k in passthrough])
