"""Secret scans over a trigram index, in DataFrame operations only.

Each rule's pattern gives a Boolean query of the trigrams that every match must hold.
The index lists, for each of these trigrams, the documents that hold it; postings are
intersected as the queries say, and only the documents left are searched for the
rule.  A rule without mandatory trigrams searches all documents.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as rc
from re import _parser as rp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

# Marks the borders of matches; a text that holds it gets OTHER there, which no rule matches either.
MARK, OTHER = "\ue000", "\ue001"


@dataclass(frozen=True)
class Rule:
    """A kind of secret.  ``pattern`` has one group at least; a match counts if ``group`` has
    ``least`` characters or more.  Matches are leftmost and don't overlap."""

    kind: str
    pattern: str
    group: int = 1
    least: int = 1


#: The three base kinds in the order in which they are listed.
BASE = (
    Rule("assign", "((?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+))", 2, 12),
    Rule("access", "(AKIA[A-Z0-9]+)", 1, 18),
    Rule("hex", "([0-9a-f]{16,})", 1, 16),
)
# A private key runs on from its header, over header lines and base64, to its END line; without
# one, to the end of the base64 run: whole lines and a last short one.  Line ends may be written
# out as in JSON.  Possessive repeats: no way back, and no recursion in Java's matcher.
_BREAK, _BLANK = r"(?:[\r\n]|\\[rn])", r"(?:\s|\\[rn])"
_KEY = "-----{} [A-Z ]{{0,20}}PRIVATE KEY-----"
_HEADERS = rf"(?:{_BREAK}{{1,2}}[A-Za-z][A-Za-z0-9-]{{0,40}}:\x20[^\r\n\\]{{0,200}}+){{0,4}}+"
_LAST = rf"""(?:{_BREAK}{{1,2}}+(?:[A-Za-z0-9+/]{{1,15}}={{1,2}}|(?:[A-Za-z0-9+/]{{4}}){{1,3}}(?=[\r\n"'\\])|[A-Za-z0-9+/]{{1,15}}$))?"""
_RUN = rf"(?:{_BLANK}{{1,4}}+[A-Za-z0-9+/=]{{16,}}+)++{_LAST}"
_PEM = rf"""({_KEY.format("BEGIN")}(?:{_HEADERS}(?:[A-Za-z0-9+/=\s\\"',]*+{_KEY.format("END")}|{_RUN}))?)"""

#: Kinds beyond them.
MORE = (
    Rule("github", "(gh[opsu]_[A-Za-z0-9]{36,})"),
    Rule("jwt", "(eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,})"),
    Rule("pem", _PEM),
)


def trigram_query(pattern: str, most: int = 24):
    """Boolean query of lower-case trigrams that every match holds: a trigram, ("and", ...),
    ("or", ...), or True where nothing is mandatory.

    Follows the pattern as a sequence: literals, small classes, branches and optional
    parts grow a set of possible strings; whatever can't be spelled out ends them,
    and the set becomes an "or" over its strings of the "and" of their trigrams.
    """

    def strings(items) -> set[str] | None:
        """All strings that items match, if they are few."""
        out = {""}
        for op, arg in items:
            if op is rc.LITERAL:
                one = {chr(arg).lower()}
            elif op is rc.IN and all(o is rc.LITERAL for o, _ in arg):
                one = {chr(c).lower() for _, c in arg}
            elif op is rc.SUBPATTERN:
                one = strings(arg[3])
            elif op is rc.BRANCH:
                parts = [strings(b) for b in arg[1]]
                one = None if None in parts else set().union(*parts)
            elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[1] != rc.MAXREPEAT and arg[1] <= 1:
                inner = strings(arg[2])
                one = inner if arg[0] else inner and inner | {""}
            else:
                one = None
            if one is None or len(out) * len(one) > most:
                return None
            out = {a + b for a in out for b in one}
        return out

    def needed(words: set[str]):
        if any(len(w) < 3 for w in words):
            return True
        sets = [{w[i:i + 3] for i in range(len(w) - 2)} for w in sorted(words)]
        least = [x for x in sets if not any(y < x for y in sets)]  # the others ask for no more
        return _any([_all(sorted(x)) for x in least])

    def query(items):
        parts, run = [], []

        def close():
            if run:
                words = strings(run)
                parts.append(needed(words))
                run.clear()

        for item in items:
            if item[0] is rc.SUBPATTERN and strings([item]) is None:
                close()
                parts.append(query(item[1][3]))
            elif strings([*run, item]) is not None:
                run.append(item)
            else:
                close()
                if strings([item]) is not None:
                    run.append(item)
                elif item[0] is rc.BRANCH:
                    parts.append(_any([query(b) for b in item[1][1]]))
                elif item[0] in (rc.MAX_REPEAT, rc.MIN_REPEAT) and item[1][0] > 0:
                    parts.append(query(item[1][2]))
        close()
        return _all(parts)

    return query(list(rp.parse(pattern)))


def _all(parts):
    flat = [q for p in parts if p is not True for q in (p[1:] if p[0] == "and" else [p])]
    parts = list(dict.fromkeys(flat))
    return True if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _any(parts):
    parts = list(dict.fromkeys(parts))
    return True if True in parts else parts[0] if len(parts) == 1 else ("or", *parts)


def trigrams_of(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1:]))


def _holds(query, held: Column) -> Column:
    if isinstance(query, str):
        return F.array_contains(held, query)
    parts = [_holds(q, held) for q in query[1:]]
    out = parts[0]
    for p in parts[1:]:
        out = (out & p) if query[0] == "and" else (out | p)
    return out


def trigram_index(docs: DataFrame, trigrams: list[str], id_col: str, text_col: str) -> DataFrame:
    """Postings (``trigram``, ``id``) of the trigrams that some rule asks for, case ignored."""
    low = F.lower(F.col(text_col))
    found = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), low.alias("low")).select(
        "id", F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams])).alias("held"))
    return found.where(F.size("held") > 0).select(F.explode("held").alias("trigram"), "id")


def candidates(index: DataFrame, queries: dict[str, object]) -> DataFrame:
    """(``id``, ``rules``): the documents in the intersection that each rule's query asks for."""
    held = index.groupBy("id").agg(F.collect_set("trigram").alias("held"))
    rules = F.array_compact(F.array(*[F.when(_holds(q, F.col("held")), F.lit(k)) for k, q in queries.items()]))
    return held.select("id", rules.alias("rules")).where(F.size("rules") > 0)


def _pieces(rule: Rule, text: Column) -> Column:
    """The text cut at the borders of matches: gap, match, [group], gap, ..., gap."""
    mark = f"{MARK}$1{MARK}" + (f"${rule.group}{MARK}" if rule.group > 1 else "")
    return F.split(F.regexp_replace(text, F.lit(rule.pattern), F.lit(mark)), MARK)


def _hidden(text: Column) -> Column:
    """A text without MARK, from which :func:`_shown` makes the text again: what it has of the marks is
    spelled as pairs.  No rule matches these characters."""
    spelled = F.replace(F.replace(text, F.lit(OTHER), F.lit(OTHER + "\ue002")), F.lit(MARK), F.lit(OTHER + "\ue003"))
    return F.when(text.rlike(f"[{MARK}{OTHER}]"), spelled).otherwise(text)


def _shown(text: Column) -> Column:
    plain = F.replace(F.replace(text, F.lit(OTHER + "\ue003"), F.lit(MARK)), F.lit(OTHER + "\ue002"), F.lit(OTHER))
    return F.when(F.contains(text, F.lit(OTHER)), plain).otherwise(text)


def _flagged(docs: DataFrame, rules: tuple[Rule, ...], id_col: str, text_col: str, spell: bool = False) -> DataFrame:
    """``__row`` (all columns), ``__text`` without MARK (its places kept, or with ``spell`` so that the
    text can be had back), ``__rules`` that may match."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    asked = {k: q for k, q in queries.items() if q is not True}
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct("*").alias("__row"), F.col(id_col).alias("__id"),
                       (_hidden(text) if spell else F.when(F.contains(text, F.lit(MARK)), F.translate(text, MARK, OTHER))
                        .otherwise(text)).alias("__text"))
    if not asked:
        return rows.withColumn("__rules", F.array().cast("array<string>"))
    trigrams = sorted(set().union(*map(trigrams_of, asked.values())))
    index = stored(trigram_index(docs, trigrams, id_col, text_col), "trigram-index")
    found = stored(candidates(index, asked), "trigram-candidates")
    # merge: the same plan whatever the size of the list; both sides are plain scans
    return (rows.join(found.hint("merge"), rows["__id"].eqNullSafe(found["id"]), "left")
            .select("__row", "__id", "__text", F.coalesce("rules", F.array().cast("array<string>")).alias("__rules")))


def _may(rule: Rule) -> Column:
    full = trigram_query(rule.pattern) is True
    return F.lit(True) if full else F.array_contains("__rules", rule.kind)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, *, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``__row`` (the columns of ``docs``), ``__text`` and ``__spans``: array of (start, rank, end,
    kind) by start and then by the order of the rules; code points, end exclusive.

    The sums that place the matches are taken over about sqrt(n) groups of matches, so
    that a text of secrets alone stays far below quadratic work.
    """
    x = _flagged(docs, rules, id_col, text_col)
    spans = []
    for rank, rule in enumerate(rules):
        width = 3 if rule.group > 1 else 2
        none = "array()"
        cut, lens, got = f"__cut{rank}", f"__len{rank}", f"__got{rank}"
        x = x.withColumn(cut, F.when(_may(rule), _pieces(rule, F.col("__text"))))
        x = x.withColumn(lens, F.when(F.size(cut) > 1, F.transform(cut, F.length))).drop(cut)
        # steps: gap + match of each; sums: of each group of g steps; starts: before each group
        x = x.withColumn(got, F.expr(f"""CASE WHEN {lens} IS NOT NULL THEN
            transform(sequence(0, (size({lens}) - 1) div {width} - 1), i -> struct(
                {lens}[i * {width}] AS gap, {lens}[i * {width} + 1] AS len, {lens}[i * {width} + {width - 1}] AS part)) END"""))
        x = x.withColumn(f"__g{rank}", F.expr(f"CAST(ceil(sqrt(size({got}))) AS int)"))
        x = x.withColumn(f"__sum{rank}", F.expr(f"""transform(sequence(0, (size({got}) - 1) div __g{rank}),
            k -> aggregate(slice({got}, k * __g{rank} + 1, __g{rank}), 0, (a, m) -> a + m.gap + m.len))"""))
        x = x.withColumn(f"__off{rank}", F.expr(f"""transform(__sum{rank},
            (s, k) -> aggregate(slice(__sum{rank}, 1, k), 0, (a, b) -> a + b))"""))
        x = x.withColumn(f"__span{rank}", F.expr(f"""CASE WHEN {got} IS NULL THEN
              CAST({none} AS array<struct<start:int,rank:int,end:int,kind:string>>)
            ELSE transform(filter(transform({got}, (m, i) -> struct(
              __off{rank}[i div __g{rank}] + m.gap + aggregate(
                slice({got}, (i div __g{rank}) * __g{rank} + 1, i % __g{rank}), 0, (a, b) -> a + b.gap + b.len) AS start,
              m.len AS len, m.part AS part)), m -> m.part >= {rule.least}),
              m -> struct(m.start AS start, {rank} AS rank, m.start + m.len AS end, '{rule.kind}' AS kind)) END"""))
        x = x.drop(lens, got, f"__g{rank}", f"__sum{rank}", f"__off{rank}")
        spans.append(f"__span{rank}")
    return x.select("__row", "__text", F.array_sort(F.concat(*spans)).alias("__spans"))


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, *, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (op8's contract) of each row.

    A null text counts as empty; null and repeated ids keep a row for each row (repeated
    ids with other texts are searched as well); an empty table gives no rows; other
    columns are not returned.
    """
    names = [r.kind for r in BASE]
    base = ", ".join(f"'{n}'" for n in names)
    found = find_secrets(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), rules,
                         id_col="doc_id", text_col="text").select("__row", "__spans")
    joined = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    return found.select(
        F.col("__row.doc_id").alias(id_col),
        *[F.expr(f"CAST(size(filter(__spans, s -> s.kind = '{n}')) AS bigint)").alias(f"n_{n}") for n in names],
        F.sha2(F.expr(joined.format(f"filter(__spans, s -> s.kind IN ({base}))")), 256).alias("base_sha256"),
        F.expr(joined.format("__spans")).alias("spans"))


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = MORE + BASE, *, id_col: str = "doc_id",
                   text_col: str = "text", length_col: str | None = "n_chars", put: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret replaced by ``put``, rule after rule; ``length_col``, if there
    is one, becomes the new length of a changed text.  Rows without secrets, null texts
    among them, stay as they are, and so does the rest of a text; no row is dropped."""
    columns = docs.columns
    x = _flagged(docs, rules, id_col, text_col, spell=True).withColumn("__out", F.col("__text"))
    for rule in rules:
        width = 3 if rule.group > 1 else 2
        x = x.withColumn("__cut", F.when(_may(rule), _pieces(rule, F.col("__out"))))
        x = x.withColumn("__out", F.expr(f"""CASE WHEN size(__cut) > 1 THEN concat(array_join(transform(
            sequence(0, (size(__cut) - 1) div {width} - 1), i -> concat(__cut[i * {width}],
              CASE WHEN length(__cut[i * {width} + {width - 1}]) >= {rule.least} THEN '{put}'
              ELSE __cut[i * {width} + 1] END)), ''), __cut[size(__cut) - 1]) ELSE __out END""")).drop("__cut")
    changed = F.col("__out") != F.col("__text")
    x = x.withColumn("__new", _shown(F.col("__out")))
    new = {text_col: F.when(changed, F.col("__new")).otherwise(F.col(f"__row.`{text_col}`"))}
    if length_col in columns:
        old = F.col(f"__row.`{length_col}`")
        new[length_col] = F.when(changed, F.length("__new").cast(docs.schema[length_col].dataType)).otherwise(old)
    return x.select(*[new.get(c, F.col(f"__row.`{c}`")).alias(c) for c in columns])
