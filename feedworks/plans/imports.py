"""Feed imports (G1-G3): scan -> clean -> validate -> keep-first -> children.

Each job returns lazy DataFrames in a dict; nothing runs until the caller writes
them.  The cleaned feed, with the reason of every record that is turned down, feeds the
parent table, its child tables, the rejects and the counts.  Who writes several of these
keeps it with ``keep`` (memory and disk; on executor loss Spark recomputes the lost
blocks from the scan).  One output alone is made from the scan, with the columns it needs:
a copy of the cleaned feed is several times larger than the feed and costs more than that.

Rejects of every step share one layout: ``table, key, reject_reason, record, lines``
(the text and its number of lines for records that could not be read).  ``metrics`` (A8)
counts the feed in one pass: read, each read error, rejected, valid, and the text cells
that were cut; ``plans.load`` counts what is written (A9) while it is written.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedworks.functions.staged import clean_columns, worked_out
from feedworks.functions.text import DEFAULT_MAX_LEN, jtrim
from feedworks.operators import flatten, metrics, quality, upsert
from feedworks.operators.layout import spread
from feedworks.operators.sinks import conform
from feedworks.session import materialize
from feedworks.schemas import (KEYWORDS, RECIPE_INGREDIENTS, RECIPE_INSTRUCTIONS,
                               RECIPE_INT_COLUMNS, RECIPES, RECIPES_COLUMNS, REVIEW_LIKERS,
                               REVIEWS, REVIEWS_COLUMNS, USER_FOLLOWERS, USER_FOLLOWING, USERS,
                               USERS_COLUMNS)
from feedworks.sources.csv_feed import INGEST_ORDER, Feed, read_feed

# The constraint constants of the target tables.
GENDERS = ["Male", "Female"]
AUTHOR_NAME_MAX = 100
GENDER_MAX = 10
AGE_MIN_EXCLUSIVE, AGE_MAX = 0, 120
RATING_MIN, RATING_MAX = 0, 5
READ_ERRORS = ["short_record", "unterminated_quote", "swallowed_records", "escaped_quote"]
READ = "_read_reason"


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _order(df: DataFrame):
    return [INGEST_ORDER] if INGEST_ORDER in df.columns else None


def _source(spark, source, columns, multi_line, partitions) -> DataFrame:
    """All records of the feed, those that could not be read among them, with ``READ``.

    ``partitions`` deals the records out to that many tasks after the scan, for files
    that can't be split; a ``Feed`` passed in keeps the partitioning of its producer."""
    feed = source if isinstance(source, Feed) else read_feed(spark, source, columns, multi_line)
    tagged = feed.tagged
    if tagged is None:
        tagged = feed.records.select("*", F.lit(None).cast("string").alias("record"),
                                     F.lit(None).cast("int").alias("lines"), F.lit(None).cast("string").alias(quality.REASON))
    if not isinstance(source, Feed):
        tagged = spread(tagged, partitions, by=INGEST_ORDER)
    return tagged.withColumnRenamed(quality.REASON, READ).withColumns({
        "record": F.when(F.col(READ).isNotNull(), F.col("record")),
        "lines": F.when(F.col(READ).isNotNull(), F.col("lines"))})


def _persist(df: DataFrame, persist) -> DataFrame:
    """What several outputs are made of.

    ``"checkpoint"``: a reliable checkpoint in the shared ``spark.checkpoint.dir`` (lineage
    cut; nothing recomputed after an executor loss).  ``True``: kept from the moment that
    :func:`keep` is called on the outputs, until then recomputed per output.
    ``False``: recompute per output.
    """
    return materialize(df) if persist == "checkpoint" else df


KEPT = ("cleaned", "tagged_edges", "tagged_children")


def keep(out: dict[str, DataFrame], persist=True) -> None:
    """Keep in memory and on disk what the outputs of a job share, for a caller that writes several
    of them: plans made before find it too."""
    for name in KEPT:
        if persist is True and name in out:
            out[name].persist(StorageLevel.MEMORY_AND_DISK)


def release(out: dict[str, DataFrame]) -> None:
    for name in KEPT:
        if name in out:
            out[name].unpersist()


def _key_rule(key: str) -> quality.Rule:
    """The key must parse as an int."""
    return quality.Rule(f"bad_key:{key}", F.col(key).isNotNull())


def _typed(src: DataFrame, key: str, specs, keep: list[str], rules: list[quality.Rule], persist,
           max_len: int | None, raw_doubles: bool = False) -> DataFrame:
    """The cleaned feed with ``reject_reason`` of the reader or of the first failed rule, and the
    text of the key in ``_key``: of a record that could not be read, what stands before its
    first comma."""
    order = [INGEST_ORDER] if INGEST_ORDER in src.columns else []
    named = src.withColumn("_key", F.coalesce(jtrim(key), F.regexp_extract("record", r"^\s*([^,]*)", 1)))
    typed = clean_columns(named, specs, keep=[*keep, "_key", "record", "lines", READ, *order], raw_doubles=raw_doubles,
                          max_len=max_len, cut_flags=True)
    # every output filters on the key and the reason: they are worked out once, not in each filter
    reason = quality.reason_of(rules, READ)
    tagged = worked_out(typed.withColumn(quality.REASON, reason).withColumnsRenamed({key: "_key_once", quality.REASON: "_reason_once"}),
                        **{key: F.col("_key_once"), quality.REASON: F.col("_reason_once")}).drop("_key_once", "_reason_once")
    return _persist(tagged, persist)


def _valid(typed: DataFrame, drop: list[str]) -> DataFrame:
    flags = [c for c in typed.columns if c.startswith(("_cut_", "_raw_"))]
    return typed.filter(F.col(quality.REASON).isNull()).drop(quality.REASON, READ, "_key", "record", "lines", *flags, *drop)


def _keyed(typed: DataFrame, key: str) -> DataFrame:
    """Records that could be read and have a key; children come from these."""
    return typed.filter(F.col(READ).isNull() & F.col(key).isNotNull())


def _feed_rejects(table: str, typed: DataFrame) -> DataFrame:
    return typed.filter(F.col(quality.REASON).isNotNull()).select(
        F.lit(table).alias("table"), F.col("_key").alias("key"), quality.REASON, "record", "lines")


def _row_rejects(table: str, df: DataFrame, key: Column, reason: Column) -> DataFrame:
    return df.select(F.lit(table).alias("table"), key.alias("key"), reason.alias(quality.REASON),
                     F.lit(None).cast("string").alias("record"), F.lit(None).cast("int").alias("lines"))


def _metrics(table: str, typed: DataFrame, by_partition: bool = False) -> DataFrame:
    """A8 in one pass over the cleaned feed: no join, no second scan."""
    readable, reason = F.col(READ).isNull(), F.col(quality.REASON)
    stages = {"read": readable, **{r: F.col(READ) == r for r in READ_ERRORS},
              "rejected": readable & reason.isNotNull(), "valid": reason.isNull()}
    cut = {f"cut:{c.removeprefix('_cut_')}": readable & F.col(c) for c in typed.columns if c.startswith("_cut_")}
    return metrics.stage_counts(typed, table, {**stages, **cut}, by_partition)


def _new_parents(valid: DataFrame, key: str, known: DataFrame | None, schema) -> tuple[DataFrame, DataFrame]:
    """(rows to load, all keys loaded after that): keep-first within the feed, and against
    ``known``, the rows that the target has already (K2)."""
    first = upsert.keep_first(valid, key, _order(valid))
    if known is None:
        rows = conform(first, schema)
        return rows, rows.select(key)
    rows = conform(upsert.without(first, known, [key]), schema)
    return rows, rows.select(key).unionByName(known.select(F.col(key).cast(schema[key].dataType)))


# =========================================================================== G1
def import_users(spark: SparkSession, source, multi_line: bool = False, persist: bool = True,
                 known_users: DataFrame | None = None, partitions: int | None = None,
                 max_len: int | None = DEFAULT_MAX_LEN) -> dict[str, DataFrame]:
    """G1: users feed -> users, user_followers, user_following, rejects, metrics.

    Edges come from every record with a parsable key (also later duplicates of a
    key), must reference loaded users at both ends (Q12), and are unique per pair
    (K4).  Self edges are kept for followers and dropped for following (P4).
    ``known_users`` (``author_id``) are users loaded earlier: their keys are not loaded
    again, and edges may point to them.  Text is cut to ``max_len`` (None: whole).
    """
    src = _source(spark, source, USERS_COLUMNS, multi_line, partitions)
    rules = [_key_rule("author_id"),
             quality.not_null("author_name"),
             quality.max_length("author_name", AUTHOR_NAME_MAX),
             quality.in_set("gender", GENDERS),
             quality.max_length("gender", GENDER_MAX),
             quality.in_range("age", AGE_MIN_EXCLUSIVE, AGE_MAX, low_inclusive=False)]
    typed = _typed(src, "author_id", [
        ("author_id", "int", "author_id"), ("author_name", "str", "author_name"),
        ("gender", "str", "gender"), ("age", "int", "age"),
        ("followers_count", "int", "followers_count"),
        ("following_count", "int", "following_count")], ["user_followers", "user_following"], rules, persist, max_len)
    users, parents = _new_parents(_valid(typed, ["user_followers", "user_following"]), "author_id", known_users, USERS)

    # The user end depends on the record alone: it is checked before the lists are taken
    # apart.  Both lists then go through one check of the other end, kept for the
    # edges and the rejects.
    keyed = quality.fk_tag(_keyed(typed, "author_id").select("author_id", "user_followers", "user_following"),
                           "author_id", parents, "author_id", "_user_ok")
    both = keyed.select("author_id", "_user_ok", F.explode(F.array(*[
        F.struct(F.lit(c).alias("table"), F.col(c).alias("cell")) for c in ("user_followers", "user_following")])).alias("_list"))
    edges = flatten.explode_ids(both.select("author_id", "_user_ok", "_list.table", "_list.cell"), "author_id", F.col("cell"),
                                "other", key_name="user_id", keep=("table", "_user_ok"))
    edges = edges.filter((F.col("table") == "user_followers") | (F.col("user_id") != F.col("other")))
    edges = quality.fk_tag(edges, "other", parents, "author_id", "_other_ok")
    edges = _persist(edges, persist)
    good = F.col("_user_ok") & F.col("_other_ok")
    tables, edge_rejects = {}, []
    for name, other, schema in (("user_followers", "follower_id", USER_FOLLOWERS),
                                ("user_following", "following_id", USER_FOLLOWING)):
        own = edges.filter(F.col("table") == name)
        pairs = upsert.dedup_pairs(own.filter(good).select("user_id", F.col("other").alias(other)), ["user_id", other])
        tables[name] = conform(flatten.with_surrogate_id(pairs, "id"), schema)
        edge_rejects.append(_row_rejects(name, own.filter(~good), F.concat_ws("->", "user_id", "other"),
                                         F.when(~F.col("_user_ok"), F.lit("fk:user_id")).otherwise(F.lit(f"fk:{other}"))))
    return {"users": users, **tables, "rejects": _union([_feed_rejects("users", typed), *edge_rejects]),
            "metrics": _metrics("users", typed),
            "partition_metrics": _metrics("users", typed, by_partition=True), "cleaned": typed, "tagged_edges": edges}


# =========================================================================== G2
def import_recipes(spark: SparkSession, source, users: DataFrame | None = None,
                   multi_line: bool = False, persist: bool = True, compat: bool = False,
                   known_recipes: DataFrame | None = None, partitions: int | None = None,
                   max_len: int | None = DEFAULT_MAX_LEN) -> dict[str, DataFrame]:
    """Recipes feed -> recipes, keywords, recipe_ingredients, recipe_instructions.

    Numerics are parsed as doubles (C3) then stored as INTEGER (C9, half-even) or
    NUMERIC(3,1) (C10); a given value that does not fit is a reject (Q15).  The
    author must be a loaded user when ``users`` is given (Q11, null allowed).
    Children come from every keyed record and must reference a loaded recipe (Q13); a
    record whose recipe is not loaded is a reject of ``recipe_children``.  They have
    no unique key, so duplicates stay (K5).  ``known_recipes`` (``recipe_id``) are recipes
    loaded earlier: they are not loaded again, and children may belong to them.
    """
    src = _source(spark, source, RECIPES_COLUMNS, multi_line, partitions)
    dbl = ["aggregated_rating"] + RECIPE_INT_COLUMNS
    lists = ["keywords", "recipe_ingredient", "recipe_instructions"]
    rules = [_key_rule("recipe_id"), quality.not_null("recipe_name")]
    rules += [quality.fits(f"_raw_{c}", c, c) for c in dbl]
    rules += [quality.in_range("aggregated_rating", RATING_MIN, RATING_MAX),
              quality.in_range("calories", 0),
              quality.in_range("recipe_servings", 0, low_inclusive=False)]
    typed = _typed(src, "recipe_id", [
        ("recipe_id", "int", "recipe_id"), ("recipe_name", "str", "recipe_name"),
        ("author_id", "int", "author_id"),
        *[(c, "str", c) for c in ("cook_time", "prep_time", "total_time")],
        ("date_published", "date", "date_published"), ("description", "str", "description"),
        ("recipe_category", "str", "recipe_category"),
        ("aggregated_rating", "decimal_3_1", "aggregated_rating"),
        *[(c, "int_half_even", c) for c in RECIPE_INT_COLUMNS],
        ("recipe_yield", "str", "recipe_yield"), ("favorite_users", "list", "favorite_users")],
        lists, rules, persist, max_len, raw_doubles=True)
    valid, parts = _valid(typed, lists), [_feed_rejects("recipes", typed)]
    if users is not None:
        valid, fk_bad = quality.fk_split(valid, "author_id", users, "author_id", allow_null=True)
        parts.append(_row_rejects("recipes", fk_bad, F.col("recipe_id").cast("string"), F.col(quality.REASON)))
    recipes, loaded = _new_parents(valid, "recipe_id", known_recipes, RECIPES)

    # One check of the whole records; the three lists are taken apart behind it.
    keyed = _persist(quality.fk_tag(_keyed(typed, "recipe_id").select("recipe_id", *lists),
                                    "recipe_id", loaded, "recipe_id", "_loaded"), persist)
    own = keyed.filter(F.col("_loaded"))
    kw = flatten.explode_strs(own, "recipe_id", F.col("keywords"), "keyword_text", compat=compat)
    ing = flatten.explode_normalized(own, "recipe_id", F.col("recipe_ingredient"), "ingredient_text", compat=compat)
    steps = flatten.explode_steps(own, "recipe_id", F.col("recipe_instructions"), compat=compat)
    children = {name: conform(flatten.with_surrogate_id(df, sid), schema) for name, df, schema, sid in (
        ("keywords", kw, KEYWORDS, "keyword_id"), ("recipe_ingredients", ing, RECIPE_INGREDIENTS, "ingredient_id"),
        ("recipe_instructions", steps, RECIPE_INSTRUCTIONS, "instruction_id"))}
    parts.append(_row_rejects("recipe_children", keyed.filter(~F.col("_loaded")), F.col("recipe_id").cast("string"),
                              F.lit("fk:recipe_id")))
    return {"recipes": recipes, **children, "rejects": _union(parts), "metrics": _metrics("recipes", typed),
            "partition_metrics": _metrics("recipes", typed, by_partition=True),
            "cleaned": typed, "tagged_children": keyed}


# =========================================================================== G3
def import_reviews(spark: SparkSession, source, multi_line: bool = False, persist: bool = True,
                   known_reviews: DataFrame | None = None, partitions: int | None = None,
                   max_len: int | None = DEFAULT_MAX_LEN) -> dict[str, DataFrame]:
    """Reviews feed -> reviews, review_likers.  No foreign keys are enforced;
    likers keep duplicates (K5).  ``known_reviews`` are not loaded again."""
    src = _source(spark, source, REVIEWS_COLUMNS, multi_line, partitions)
    rules = [_key_rule("review_id"), quality.not_null("author_id"),
             quality.in_range("rating", RATING_MIN, RATING_MAX)]
    typed = _typed(src, "review_id", [
        ("review_id", "int", "review_id"), ("recipe_id", "int", "recipe_id"),
        ("author_id", "int", "author_id"), ("rating", "int", "rating"),
        ("review_content", "str", "review_content"),
        ("date_submitted", "date", "date_submitted"), ("date_modified", "date", "date_modified")],
        ["likes"], rules, persist, max_len)
    reviews, _ = _new_parents(_valid(typed, ["likes"]), "review_id", known_reviews, REVIEWS)
    likers = flatten.explode_ids(_keyed(typed, "review_id"), "review_id", F.col("likes"), "liker_id")
    review_likers = conform(flatten.with_surrogate_id(likers, "like_id"), REVIEW_LIKERS)
    return {"reviews": reviews, "review_likers": review_likers, "rejects": _feed_rejects("reviews", typed),
            "metrics": _metrics("reviews", typed),
            "partition_metrics": _metrics("reviews", typed, by_partition=True), "cleaned": typed}
