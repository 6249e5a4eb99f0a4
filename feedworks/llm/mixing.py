"""Mixing sources to target weights by hierarchical budgets, in DataFrame operations only.

Weights go down the tree domain - language - source.  A node that can't spend its share
leaves the shortage to its siblings, in proportion to their weights, and only what they
can't spend either goes to the siblings of its ancestors.  Each leaf then takes whole
epochs of its documents and a prefix of one more epoch in a seeded order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, stored

#: Stands for a null language, source or domain.
NONE = "(none)"
LEVELS = ("domain", "lang", "source")


def source_family(source: str = "source", families: int = 4) -> Column:
    """Domain of a source by the number at the end of its name; none: ``(none)``."""
    digits = F.regexp_extract(F.coalesce(F.col(source), F.lit("")), r"([0-9]{1,9})$", 1)
    return F.when(digits != "", F.concat(F.lit("domain"), (digits.cast("long") % families).cast("string"))) \
        .otherwise(F.lit(NONE))


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    known = weights.get(level) or {}
    if not known:
        return F.lit(1).cast("long")
    pairs = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, F.col(level)), F.lit(1)).cast("long")


def fill(nodes: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Split each parent's ``budget`` over its children by ``weight``, none above its ``cap``.

    Adds ``share`` (long, rounded down).  Children are ordered by cap / weight: those at
    the front are full as long as the level that the rest would reach lies above them.
    A child of weight 0 gets nothing.
    """
    big = "decimal(19,0)"
    of = W.partitionBy(*parent)
    order = of.orderBy(F.col("cap") / F.col("weight"), F.col(child))
    x = (nodes.withColumn("cap", F.when(F.col("weight") > 0, F.col("cap")).otherwise(F.lit(0)).cast("long"))
         .withColumn("weight", F.greatest("weight", F.lit(1)))
         .withColumn("budget", F.least("budget", F.sum("cap").over(of)))
         .withColumn("spent", F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("open", F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)))
         .withColumn("full", F.col("cap").cast(big) * F.col("open").cast(big)
                     <= (F.col("budget") - F.col("spent")).cast(big) * F.col("weight").cast(big))
         .withColumn("rest", F.col("budget") - F.min(F.when(~F.col("full"), F.col("spent"))).over(of))
         .withColumn("over", F.max(F.when(~F.col("full"), F.col("open"))).over(of)))
    part = F.expr("CAST(rest AS decimal(19,0)) * CAST(weight AS decimal(19,0)) div CAST(over AS decimal(19,0))")
    return (x.withColumn("share", F.when(F.col("full"), F.col("cap")).otherwise(part).cast("long"))
            .drop("spent", "open", "full", "rest", "over"))


def leaf_budgets(leaves: DataFrame, weights: dict[str, dict[str, int]], max_epochs: int,
                 share: tuple[int, int], budget: int | None = None) -> DataFrame:
    """``leaves`` (domain, lang, source, available, n_docs) with ``tokens``, what each may
    spend: of ``budget``, or of that share of all available tokens."""
    can = F.when(F.col("weight") > 0, F.col("cap")).otherwise(F.lit(0)).cast("long")  # weight 0 spends nothing, its parent must know
    leaf = leaves.select(*LEVELS, "available", "n_docs", (F.col("available") * max_epochs).alias("cap"),
                         _weight("source", weights).alias("weight")).withColumn("cap", can)
    both = F.sum("cap").alias("cap"), F.sum("available").alias("available")
    langs = leaf.groupBy("domain", "lang").agg(*both).withColumn("weight", _weight("lang", weights)).withColumn("cap", can)
    tops = langs.groupBy("domain").agg(*both) \
        .withColumn("weight", _weight("domain", weights)).withColumn("root", F.lit(0))
    whole = F.lit(budget).cast("long") if budget is not None else \
        (F.expr(f"sum(available) over (partition by root) * {share[0]} div {share[1]}"))
    tops = fill(tops.withColumn("budget", whole), ["root"], "domain")
    langs = fill(langs.join(tops.select("domain", F.col("share").alias("budget")), "domain"), ["domain"], "lang")
    leaf = fill(leaf.join(langs.select("domain", "lang", F.col("share").alias("budget")), ["domain", "lang"]),
                ["domain", "lang"], "source")
    return leaf.select(*LEVELS, "available", "n_docs", F.col("share").alias("tokens"))


def _keyed(docs: DataFrame, id_col: str, text_col: str, domain: Column) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.coalesce(domain, F.lit(NONE)).alias("domain"), F.coalesce("lang", F.lit(NONE)).alias("lang"),
        F.coalesce("source", F.lit(NONE)).alias("source"), F.col(id_col).alias("id"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_tokens"), F.xxhash64(text).alias("tie"))


def _order(seed: int) -> Column:
    """Place of a document in the epoch after the leaf's whole ones; ties only between
    rows with the same id, number of tokens and text."""
    name = F.coalesce(F.col("id").cast("string"), F.lit(""))
    return F.concat(F.md5(F.concat_ws(":", F.lit(str(seed)), (F.col("epochs") + 1).cast("string"), name)),
                    F.lit("|"), name, F.lit("|"), F.col("n_tokens").cast("string"), F.lit("|"), F.col("tie").cast("string"))


def plan_mix(docs: DataFrame, *, weights: dict[str, dict[str, int]] | None = None, share: tuple[int, int] = (1, 1),
             budget: int | None = None, max_epochs: int = 3, seed: int = 11, domain: Column | None = None,
             id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """What each leaf takes, and the narrow table of documents that it was worked out from.

    Leaves: domain, lang, source, available, n_docs, tokens, epochs (whole ones) and
    ``cut``, the last place taken of the next epoch (null: none).  A document counts
    if its leaf's running sum up to it stays within the rest of the budget; rows that
    tie count together.  Weights are integers from 0; missing ones are 1.

    No leaf is gathered in one task: its places are cut into about sqrt(n) ranges, whose
    sums find the one range in which the budget ends, and only that is summed by row.
    """
    weights = weights or {}
    rows = stored(_keyed(docs, id_col, text_col, domain if domain is not None else source_family()), "mix-rows")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("available"), F.count(F.lit(1)).alias("n_docs"))
    leaves = stored(leaf_budgets(stored(leaves, "mix-leaves"), weights, max_epochs, share, budget), "mix-budgets")
    leaves = leaves.withColumn("epochs", F.when(F.col("available") > 0, F.expr("tokens div available")).otherwise(F.lit(0))) \
        .withColumn("rest", F.col("tokens") - F.col("epochs") * F.col("available"))
    ranges = F.ceil(F.sqrt("n_docs")).cast("long")
    first = F.conv(F.substring("place", 1, 8), 16, 10).cast("long")
    placed = (rows.join(leaves.where("rest > 0").select(*LEVELS, "epochs", "rest", ranges.alias("ranges")), list(LEVELS))
              .withColumn("place", _order(seed))
              .withColumn("range", F.floor(first * F.col("ranges") / F.lit(4294967296)).cast("long"))
              .select(*LEVELS, "range", "place", "n_tokens", "rest"))
    placed = stored(placed, "mix-places")
    sums = placed.groupBy(*LEVELS, "range").agg(F.sum("n_tokens").alias("sum"), F.max("place").alias("last"),
                                                F.first("rest").alias("rest"))
    upto = W.partitionBy(*LEVELS).orderBy("range").rowsBetween(W.unboundedPreceding, 0)
    sums = stored(sums.withColumn("upto", F.sum("sum").over(upto)), "mix-ranges")
    whole = sums.where("upto <= rest").select(*LEVELS, F.col("last").alias("place"))
    ends = sums.where("upto > rest AND upto - sum <= rest").select(*LEVELS, "range", (F.col("upto") - F.col("sum")).alias("before"))
    running = W.partitionBy(*LEVELS, "range").orderBy("place").rangeBetween(W.unboundedPreceding, W.currentRow)
    part = (placed.join(ends, [*LEVELS, "range"]).withColumn("upto", F.col("before") + F.sum("n_tokens").over(running))
            .where("upto <= rest").select(*LEVELS, "place"))
    cuts = whole.unionByName(part).groupBy(*LEVELS).agg(F.max("place").alias("cut"))
    plan = leaves.join(cuts, list(LEVELS), "left").select(*LEVELS, "available", "n_docs", "tokens", "epochs", "cut")
    return stored(plan, "mix-plan"), rows


def _copies(seed: int) -> Column:
    taken = F.coalesce(_order(seed) <= F.col("cut"), F.lit(False))
    return F.coalesce(F.col("epochs") + taken.cast("long"), F.lit(0))


def mix(docs: DataFrame, *, seed: int = 11, **plan_args) -> DataFrame:
    """doc_id, domain, lang, source, n_tokens (runs of characters other than space and
    0x09 to 0x0D) and n_copies, in how many epochs the document is taken (0: not at all).

    A row for each row of ``docs``.  Null texts have no tokens; a null language or source
    is the value ``(none)``; rows with null ids take part like any other; an empty
    table gives no rows; other columns are not read.
    """
    plan, rows = plan_mix(docs, seed=seed, **plan_args)
    return (rows.join(plan.select(*LEVELS, "epochs", "cut"), list(LEVELS), "left")
            .select(F.col("id").alias(plan_args.get("id_col", "doc_id")), *LEVELS, "n_tokens", _copies(seed).alias("n_copies")))


def take_mix(docs: DataFrame, *, seed: int = 11, id_col: str = "doc_id", text_col: str = "text",
             domain: Column | None = None, **plan_args) -> DataFrame:
    """The rows of ``docs``, all their columns, each as often as the mix takes it."""
    domain = domain if domain is not None else source_family()
    plan, _ = plan_mix(docs, seed=seed, id_col=id_col, text_col=text_col, domain=domain, **plan_args)
    named = F.struct("*").alias("__row")
    keyed = docs.select(named, F.coalesce(domain, F.lit(NONE)).alias("domain"), F.coalesce("lang", F.lit(NONE)).alias("lang"),
                        F.coalesce("source", F.lit(NONE)).alias("source"), F.col(id_col).alias("id"),
                        F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long").alias("n_tokens"),
                        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tie"))
    taken = (keyed.join(plan.select(*LEVELS, "epochs", "cut"), list(LEVELS), "left")
             .withColumn("__n", _copies(seed)).where("__n > 0"))
    return taken.withColumn("__n", F.explode(F.expr("sequence(1L, __n)"))).select("__row.*")


#: Target weights of the registered query.
WEIGHTS = {"domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1}, "lang": {"en": 6, "de": 2, "fr": 2}}

_FILL = """
{name}_a AS (SELECT *, least(budget0, sum(cap) OVER (PARTITION BY {parent}))::HUGEINT AS budget,
    coalesce(sum(cap) OVER (PARTITION BY {parent} ORDER BY cap / weight, {child}
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS spent,
    sum(weight) OVER (PARTITION BY {parent} ORDER BY cap / weight, {child}
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS open_ FROM {source}),
{name}_b AS (SELECT *, cap * open_ <= (budget - spent) * weight AS is_full FROM {name}_a),
{name}_c AS (SELECT *, budget - min(spent) FILTER (NOT is_full) OVER (PARTITION BY {parent}) AS rest,
    max(open_) FILTER (NOT is_full) OVER (PARTITION BY {parent}) AS over_ FROM {name}_b),
{name} AS (SELECT *, CASE WHEN is_full THEN cap ELSE rest * weight // over_ END AS share FROM {name}_c),"""


def oracle_sql(weights=None, share=(1, 1), max_epochs: int = 3, seed: int = 11, families: int = 4) -> str:
    """The same mix in DuckDB, with a plain running sum over each leaf."""
    weights = WEIGHTS if weights is None else weights

    def weight(level):
        cases = "".join(f" WHEN '{k}' THEN {v}" for k, v in (weights.get(level) or {}).items())
        return f"(CASE {level}{cases} ELSE 1 END)" if cases else "1"

    digits = "regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1)"
    return f"""
WITH rows_ AS (SELECT doc_id, coalesce(lang, '{NONE}') AS lang, coalesce(source, '{NONE}') AS source,
    CASE WHEN {digits} <> '' THEN 'domain' || CAST(CAST({digits} AS BIGINT) % {families} AS VARCHAR) ELSE '{NONE}' END AS domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens FROM documents),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS available,
    CASE WHEN {weight('source')} > 0 THEN sum(n_tokens)::HUGEINT * {max_epochs} ELSE 0 END AS cap,
    greatest({weight('source')}, 1) AS weight FROM rows_ GROUP BY domain, lang, source),
lang_ AS (SELECT domain, lang, CASE WHEN {weight('lang')} > 0 THEN sum(cap)::HUGEINT ELSE 0 END AS cap, sum(available)::HUGEINT AS available,
    greatest({weight('lang')}, 1) AS weight FROM leaf GROUP BY domain, lang),
top_ AS (SELECT domain, CASE WHEN {weight('domain')} > 0 THEN sum(cap)::HUGEINT ELSE 0 END AS cap,
    greatest({weight('domain')}, 1) AS weight, 0 AS root,
    (sum(sum(available)) OVER () * {share[0]})::HUGEINT // {share[1]} AS budget0 FROM lang_ GROUP BY domain),
{_FILL.format(name='top_f', parent='root', child='domain', source='top_')}
lang_b AS (SELECT l.* EXCLUDE (available), t.share AS budget0 FROM lang_ l JOIN top_f t USING (domain)),
{_FILL.format(name='lang_f', parent='domain', child='lang', source='lang_b')}
leaf_b AS (SELECT l.*, t.share AS budget0 FROM leaf l JOIN lang_f t USING (domain, lang)),
{_FILL.format(name='leaf_f', parent='domain, lang', child='source', source='leaf_b')}
plan_ AS (SELECT domain, lang, source, CASE WHEN available > 0 THEN share // available ELSE 0 END AS epochs,
    CASE WHEN available > 0 THEN share % available ELSE 0 END AS rest FROM leaf_f),
ordered AS (SELECT r.*, p.epochs, p.rest, sum(n_tokens) OVER (PARTITION BY r.domain, r.lang, r.source
    ORDER BY md5('{seed}:' || CAST(p.epochs + 1 AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR)), doc_id
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
    FROM rows_ r JOIN plan_ p USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens,
    CAST(epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS n_copies FROM ordered"""
