"""Query catalogue over the driver tables: one entry per operator.

The driver tables are not the feeds, so every operator runs on an analogue:

* users            -> ``part``: key p_partkey, name p_name, gender p_type,
                      age p_size, followers p_retailprice, following p_size
* user_followers   -> ``lineitem``: user l_partkey, follower l_suppkey
* raw feed records -> text cells built row by row from ``lineitem`` / ``part`` /
                      ``events`` / ``documents`` (every row of the table, whole texts)

Each ``q_*`` builds its result with the library operators; ``ORACLE`` holds an
independent DuckDB statement for the same result (used by the correctness gate).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedworks import functions as fx
from feedworks.operators import changes, flatten, ledger, metrics, quality, reports, sinks, stored, upsert
from feedworks.operators.layout import spread
from feedworks.plans import imports, suites
from feedworks.schemas import RECIPES_COLUMNS, REVIEWS_COLUMNS, TARGETS, USERS_COLUMNS
from feedworks.session import shared_path
from feedworks.sources import from_rows, table
from feedworks.sources.csv_feed import read_records, split_lines

PART_USERS = suites.UserCols(key="p_partkey", name="p_name", gender="p_type", age="p_size",
                             followers="p_retailprice", following="p_size",
                             edge_user="l_partkey", edge_target="l_suppkey")
# Thresholds of the analogue (part prices run 900..1000, sizes 1..50).
PART_PARAMS = suites.SuiteParams(followers_min=950, gender_value="ECONOMY", delete_age_above=45,
                                 female_spellings=("economy", "e"))
AVG_DIGITS = 6
KEYS = ["l_orderkey", "l_linenumber"]
LINE_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]
LOAD_CUTOFF = "1997-01-01"


def _t(spark, sf, name) -> DataFrame:
    return table(spark, sf, name)


def _heavy(spark, sf, name) -> DataFrame:
    """A table about to get CPU-heavy row-local parsing.  Whoever knows that its files can't
    be split (one row group each) sets ``feedworks.input.partitions``; nothing is
    dealt out anew otherwise."""
    wanted = spark.conf.get("feedworks.input.partitions", None)
    return spread(table(spark, sf, name), int(wanted) if wanted else None)


def _r(c: str, n: int = AVG_DIGITS) -> Column:
    return F.round(F.col(c), n).alias(c)


# ============================================================== A1 A2 P5-P8 (reports)
def q_count_all(spark, sf):
    return reports.count_all(_t(spark, sf, "part"))


def q_filter_counts(spark, sf):
    return suites.suite_counts(_t(spark, sf, "part"), PART_USERS, PART_PARAMS)


def q_filter_between(spark, sf):
    return reports.where(_t(spark, sf, "part"), reports.between("p_size", 25, 35)) \
        .select("p_partkey", "p_name", "p_size")


def q_filter_greater(spark, sf):
    return reports.where(_t(spark, sf, "part"), reports.greater("p_retailprice", 950)) \
        .select("p_partkey", "p_retailprice")


def q_filter_equals(spark, sf):
    return reports.where(_t(spark, sf, "part"), reports.equals("p_type", "ECONOMY")) \
        .select("p_partkey", "p_type")


def q_filter_any_case(spark, sf):
    return reports.where(_t(spark, sf, "customer"),
                         reports.any_case_in("c_mktsegment", ["building", "b"])) \
        .select("c_custkey", "c_mktsegment")


# ============================================================== A3 A4 A6 A7 J4
def q_group_having_sort(spark, sf):
    out = reports.group_having_sort(
        _t(spark, sf, "part"), "p_type", {"avg_followers": "p_retailprice", "avg_following": "p_size"},
        pred=reports.between("p_size", 20, 40), min_count=10, order_by="avg_followers")
    return out.select("p_type", _r("avg_followers"), _r("avg_following"), "count")


def q_left_join_distinct(spark, sf):
    # every third part gets a key that no line has: users without edges
    users = _t(spark, sf, "part").withColumn("p_partkey", F.when(F.col("p_partkey") % 3 == 0, -F.col("p_partkey"))
                                             .otherwise(F.col("p_partkey")))
    out = reports.left_join_distinct(users, _t(spark, sf, "lineitem"), "p_partkey", "l_partkey",
                                     "l_suppkey", "p_type", "p_retailprice",
                                     pred=reports.between("p_size", 18, 60))
    return out.select("p_type", "unique_followers", _r("avg_followers"))


def q_decade_average(spark, sf):
    out = reports.decade_average(_t(spark, sf, "part"), "p_size", "p_retailprice",
                                 avg_name="avg_followers", count_name="n")
    return out.select("age_group", _r("avg_followers"), "n")


def q_global_stats(spark, sf):
    out = reports.global_stats(_t(spark, sf, "customer"), "c_acctbal")
    return out.select(_r("total", 2), _r("mean"))


def q_above_global_avg(spark, sf):
    return reports.above_global_avg(_t(spark, sf, "customer"), "c_acctbal",
                                    reports.any_case_in("c_mktsegment", ["building", "b"])) \
        .select("c_custkey", "c_name", "c_acctbal")


# ============================================================== U1-U5
def q_update_where(spark, sf):
    part = _t(spark, sf, "part")
    return changes.update_where(part, "p_retailprice", F.col("p_retailprice") + 1,
                                F.col("p_size") < 30).select("p_partkey", "p_size", "p_retailprice")


def q_update_count(spark, sf):
    return changes.affected(_t(spark, sf, "part"), F.col("p_size") < 30, "updated")


def q_delete_in_limit(spark, sf):
    return changes.delete_in_limit(_t(spark, sf, "part"), "p_partkey", F.col("p_size") > 45, 10)


def q_delete_where(spark, sf):
    return changes.delete_where(_t(spark, sf, "part"), F.coalesce(F.col("p_size"), F.lit(0)) > 40)


# ============================================================== G4 / G5 suites
def _after(spark, sf):
    return suites.suite_changes(_t(spark, sf, "part"), PART_USERS, PART_PARAMS)


def q_suite_deleted(spark, sf):
    return _after(spark, sf)[1]


def q_suite_grouped(spark, sf):
    out = suites.suite_grouped(_after(spark, sf)[2], PART_USERS, PART_PARAMS)
    return out.select("p_type", _r("avg_followers"), _r("avg_following"), "count")


def q_suite_joined(spark, sf):
    out = suites.suite_joined(_after(spark, sf)[2], _t(spark, sf, "lineitem"), PART_USERS,
                              PART_PARAMS)
    return out.select("p_type", "unique_followers", _r("avg_followers"))


def _file(spark, sf):
    users = _t(spark, sf, "part")
    return suites.file_suite(users, PART_USERS, PART_PARAMS)


def q_file_suite_bands(spark, sf):
    return _file(spark, sf)["age_bands"].select("age_group", _r("avg_followers"))


def q_file_suite_high_female(spark, sf):
    return _file(spark, sf)["high_follower_female"].select("p_partkey", "p_type", "p_retailprice")


def q_conditional_summary(spark, sf):
    return _file(spark, sf)["summary"]


# ============================================================== K2 K4 K11 Q1 Q10
def q_keep_first(spark, sf):
    return upsert.keep_first(_t(spark, sf, "lineitem"), KEYS)


def q_keep_first_existing(spark, sf):
    li = _t(spark, sf, "lineitem")
    cutoff = F.lit(LOAD_CUTOFF).cast("timestamp")
    existing = upsert.keep_first(li.filter(F.col("l_shipdate") < cutoff), KEYS)
    incoming = li.filter(F.col("l_shipdate") >= cutoff)
    return upsert.keep_first_append(incoming, existing, KEYS)


def _follower_cells(li: DataFrame) -> DataFrame:
    cell = F.concat(F.col("l_suppkey").cast("string"), F.lit(", "), F.col("l_partkey").cast("string"),
                    F.lit(",x,,"), F.col("l_suppkey").cast("string"))
    return li.select(F.col("l_orderkey").cast("int").alias("user_id"), cell.alias("cell"))


def q_edge_dedup(spark, sf):
    cells = _follower_cells(_heavy(spark, sf, "lineitem"))
    edges = flatten.explode_ids(cells, "user_id", F.col("cell"), "follower_id")
    return upsert.dedup_pairs(edges, ["user_id", "follower_id"])


def q_edge_no_self(spark, sf):
    li = _heavy(spark, sf, "lineitem")
    cells = li.select(F.col("l_suppkey").cast("int").alias("user_id"),
                      F.concat_ws(",", F.col("l_partkey").cast("string"),
                                  F.col("l_suppkey").cast("string")).alias("cell"))
    edges = flatten.explode_ids(cells, "user_id", F.col("cell"), "following_id", drop_self=True)
    return upsert.dedup_pairs(edges, ["user_id", "following_id"])


def q_drop_columns(spark, sf):
    return sinks.drop_columns(_t(spark, sf, "part"), "p_name", "p_brand", "no_such_column")


# ============================================================== Q11-Q14 referential
def _fk(spark, sf):
    # orphans: the orders of every fifth customer point past the last key
    orders = _t(spark, sf, "orders").withColumn("o_custkey", F.when(F.col("o_custkey") % 5 == 0, F.col("o_custkey") + 100_000_000)
                                                .otherwise(F.col("o_custkey")))
    return quality.fk_split(orders, "o_custkey", _t(spark, sf, "customer"), "c_custkey")


def q_fk_valid(spark, sf):
    return _fk(spark, sf)[0]


def q_fk_rejects(spark, sf):
    return _fk(spark, sf)[1]


def q_cascade_delete(spark, sf):
    deleted = _t(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return quality.cascade_delete(_t(spark, sf, "lineitem"), "l_orderkey", deleted, "o_orderkey")


# ============================================================== C1-C16 cleaners
def _int_cells(li: DataFrame) -> DataFrame:
    s = lambda c: F.col(c).cast("string")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.concat(F.lit(" "), s("l_suppkey"), F.lit(" ")).alias("a_pad"),
        F.concat(s("l_suppkey"), F.lit("."), s("l_linenumber")).alias("b_dot"),
        F.concat(F.lit("-"), s("l_partkey"), F.lit(".9")).alias("c_neg"),
        F.concat(F.lit("+"), s("l_linenumber")).alias("d_plus"),
        F.concat(s("l_orderkey"), F.lit("000000000")).alias("e_big"),
        F.concat(s("l_orderkey"), F.lit("000000000.5")).alias("f_bigdot"),
        F.concat(s("l_linenumber"), F.lit("e2")).alias("g_exp"),
        F.concat(s("l_linenumber"), F.lit(".0e2")).alias("h_dotexp"),
        F.concat(F.lit("\t"), s("l_quantity"), F.lit("\n")).alias("i_tabs"),
        F.when(F.col("l_returnflag") == "N", F.lit("n/a")).when(F.col("l_returnflag") == "R", F.lit(""))
        .otherwise(F.lit(".")).alias("j_junk"))


INT_CELLS = ["a_pad", "b_dot", "c_neg", "d_plus", "e_big", "f_bigdot", "g_exp", "h_dotexp",
             "i_tabs", "j_junk"]


def q_clean_int(spark, sf):
    cells = _int_cells(_heavy(spark, sf, "lineitem"))
    return cells.select("l_orderkey", "l_linenumber", *[fx.safe_int(c).alias(c) for c in INT_CELLS])


def q_int_or_zero(spark, sf):
    cells = _int_cells(_heavy(spark, sf, "lineitem"))
    return cells.select("l_orderkey", "l_linenumber", *[fx.int_or_zero(c).alias(c) for c in INT_CELLS])


def q_clean_str(spark, sf):
    docs = _heavy(spark, sf, "documents")
    return docs.select("doc_id", fx.safe_str("text").alias("text_clean"),
                       fx.str_or_empty("source").alias("source_clean"),
                       fx.within_length(fx.safe_str("text"), 100).alias("fits_100"))


DOUBLE_CELLS = ["a_half", "b_under", "c_neg_half", "d_exp", "e_pad", "f_junk"]


def q_clean_double_round(spark, sf):
    p = _t(spark, sf, "part")
    s = F.col("p_size").cast("string")
    cells = p.select("p_partkey",
                     F.concat(s, F.lit(".5")).alias("a_half"),
                     F.concat(s, F.lit(".49")).alias("b_under"),
                     F.concat(F.lit("-"), s, F.lit(".5")).alias("c_neg_half"),
                     F.concat(s, F.lit("e1")).alias("d_exp"),
                     F.concat(F.lit("  "), s, F.lit(".51 ")).alias("e_pad"),
                     F.concat(F.lit("x"), s).alias("f_junk"))
    return cells.select("p_partkey", *[fx.to_int_half_even(fx.safe_double(c)).alias(c)
                                       for c in DOUBLE_CELLS])


def q_clean_decimal(spark, sf):
    c = _t(spark, sf, "customer")
    text = F.col("c_acctbal").cast("string")
    return c.select("c_custkey", fx.to_decimal(fx.safe_double(text) / F.lit(1000.0), 3, 1)
                    .alias("rating"))


def q_clean_instant_date(spark, sf):
    ev = _t(spark, sf, "events")
    z = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    off = F.concat(F.date_format(F.col("ts") + F.expr("INTERVAL 8 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                   F.lit("+08:00"))
    return ev.select("event_id", fx.parse_date(z).alias("d_z"), fx.parse_date(off).alias("d_offset"),
                     fx.parse_date(F.date_format("ts", "yyyy-MM-dd")).alias("d_date_only"),
                     fx.parse_date(F.concat(F.lit(" "), z)).alias("d_padded"))


def q_decade_label(spark, sf):
    p = _t(spark, sf, "part")
    return p.select("p_partkey", fx.decade("p_size").alias("age_group"),
                    fx.decade_label("p_size").alias("label"),
                    fx.round2(F.col("p_retailprice") / 3).alias("third"))


# ============================================================== C5-C8 X3-X7 lists
def _brand_cell(p: DataFrame) -> Column:
    return F.concat(F.lit('c("'), F.col("p_brand"), F.lit('", "'), F.col("p_type"), F.lit(", "),
                    F.col("p_name"), F.lit('")'))


def q_normalize_list(spark, sf):
    p = _t(spark, sf, "part")
    return p.select("p_partkey", fx.normalize_list_text(_brand_cell(p)).alias("favorite_users"))


def q_explode_keywords(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", _brand_cell(_t(spark, sf, "part")).alias("cell"))
    return flatten.explode_strs(p, "p_partkey", F.col("cell"), "keyword_text")


def q_explode_ingredients(spark, sf):
    p = _t(spark, sf, "part")
    cells = p.select("p_partkey", _brand_cell(p).alias("cell"))
    return flatten.explode_normalized(cells, "p_partkey", F.col("cell"), "ingredient_text")


def q_parse_steps(spark, sf):
    docs = _heavy(spark, sf, "documents")
    return flatten.explode_steps(docs, "doc_id", F.col("text"), key_name="doc_id")


def q_split_quoted_compat(spark, sf):
    docs = _heavy(spark, sf, "documents")
    return flatten.explode_list(docs, "doc_id", fx.split_quoted("text", compat=True), "item")


def q_explode_likers(spark, sf):
    ev = _heavy(spark, sf, "events")
    cell = F.concat(F.lit("["), F.col("user_id").cast("string"), F.lit(", "),
                    F.col("user_id").cast("string"), F.lit(",null]"))
    cells = ev.select(F.col("event_id").cast("int").alias("review_id"), cell.alias("likes"))
    return flatten.explode_ids(cells, "review_id", F.col("likes"), "liker_id")


# ============================================================== Q2-Q9 Q15 quality
def _customer_rules():
    return [quality.not_null("c_name"),
            quality.max_length("c_mktsegment", 9),
            quality.in_set("c_mktsegment", ["BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD"]),
            quality.in_range("c_acctbal", 0, 9000),
            quality.fits("c_acctbal", "rating", "rating")]


def _customer_typed(spark, sf):
    c = _t(spark, sf, "customer")
    return c.withColumn("rating", fx.to_decimal(F.col("c_acctbal") / F.lit(100.0), 3, 1))


def q_quality_counts(spark, sf):
    return quality.rule_counts(_customer_typed(spark, sf), _customer_rules())


def q_quality_rejects(spark, sf):
    _, bad = quality.split(_customer_typed(spark, sf), _customer_rules())
    return bad.select("c_custkey", "reject_reason")


def q_quality_valid(spark, sf):
    ok, _ = quality.split(_customer_typed(spark, sf), _customer_rules())
    return ok.select("c_custkey", "c_mktsegment", "c_acctbal", "rating")


# ============================================================== G1 import on a derived feed
def users_feed_rows(li: DataFrame) -> DataFrame:
    """A raw users feed (eight text cells) with one record per lineitem row."""
    s = lambda c: F.col(c).cast("string")
    gender = (F.when(F.col("l_returnflag") == "R", F.lit("Female"))
              .when(F.col("l_returnflag") == "A", F.lit("Male")).otherwise(F.lit("Other")))
    return li.select(
        s("l_partkey"), F.concat(F.lit("User "), s("l_partkey")), gender, s("l_quantity"),
        s("l_suppkey"), s("l_linenumber"),
        F.concat((F.col("l_partkey") + 1).cast("string"), F.lit(", "), s("l_partkey"), F.lit(",x")),
        F.concat(s("l_partkey"), F.lit(","), (F.col("l_partkey") + 7).cast("string")),
        F.struct("l_orderkey", "l_linenumber").alias("_order"))


def _import_users(spark, sf):
    """G1 over the derived feed; "first" is the lineitem order (l_orderkey, l_linenumber)."""
    rows = users_feed_rows(_heavy(spark, sf, "lineitem")).toDF(*USERS_COLUMNS, "_ingest_order")
    return imports.import_users(spark, from_rows(rows, USERS_COLUMNS + ["_ingest_order"]),
                                persist=True)


def q_import_users(spark, sf):
    return _import_users(spark, sf)["users"]


def q_import_followers(spark, sf):
    return _import_users(spark, sf)["user_followers"].drop("id")


def q_import_following(spark, sf):
    return _import_users(spark, sf)["user_following"].drop("id")


def q_import_rejects(spark, sf):
    rej = _import_users(spark, sf)["rejects"]
    return rej.groupBy("table", "reject_reason").agg(F.count(F.lit(1)).alias("n"))


# ============================================================== S1-S5 P1 P2 on lines of text
def user_lines(li: DataFrame) -> DataFrame:
    """One line of a users feed per lineitem row: a doubled quote and commas in the name, one
    field too many on even lines, every seventh key no number, blank list cells on ``N`` rows."""
    s = lambda c: F.col(c).cast("string")
    key = F.when(F.col("l_partkey") % 7 == 0, F.concat(F.lit("x"), s("l_partkey"))).otherwise(s("l_partkey"))
    name = F.concat(F.lit('"Ann ""the, '), s("l_suppkey"), F.lit('"", Lee"'))
    gender = F.when(F.col("l_linestatus") == "O", F.lit("Male")).otherwise(F.lit("Female"))
    ids = F.when(F.col("l_returnflag") == "N", F.lit("  ")).otherwise(
        F.concat(F.lit('"'), s("l_suppkey"), F.lit(","), s("l_partkey"), F.lit('"')))
    extra = F.when(F.col("l_linenumber") % 2 == 0, F.lit(",one more")).otherwise(F.lit(""))
    line = F.concat_ws(",", key, name, gender, s("l_linenumber"), s("l_orderkey"), s("l_suppkey"), ids, ids)
    return li.select(F.concat(line, extra).alias("_line"), F.struct("l_orderkey", "l_linenumber").alias("_ingest_order"),
                     "l_orderkey", "l_linenumber", "l_returnflag")


def _lines_query(spark, sf, line: Column):
    rows = user_lines(_heavy(spark, sf, "lineitem"))
    return split_lines(rows.select(line.alias("_line"), "l_orderkey", "l_linenumber"), USERS_COLUMNS)


def q_feed_lines(spark, sf):
    return _lines_query(spark, sf, F.col("_line")).records


def q_feed_short(spark, sf):
    """Lines of ``R`` rows end after their third field."""
    cut = F.regexp_extract("_line", r'^([^,]*,"[^"]*""[^"]*""[^"]*",[^,]*)', 1)
    feed = _lines_query(spark, sf, F.when(F.col("l_returnflag") == "R", cut).otherwise(F.col("_line")))
    return feed.rejects.groupBy("key", "lines", "reject_reason").agg(F.count(F.lit(1)).alias("n"))


def q_feed_escaped(spark, sf):
    """Quotes in the name escaped by backslashes instead of doubled."""
    return _lines_query(spark, sf, F.replace(F.col("_line"), F.lit('""'), F.lit('\\"'))).records


def q_feed_unterminated(spark, sf):
    """The name of ``A`` rows lacks its last quote: reading those lines costs no other line."""
    broken = F.replace(F.col("_line"), F.lit('"", Lee"'), F.lit('"", Lee'))
    feed = _lines_query(spark, sf, F.when(F.col("l_returnflag") == "A", broken).otherwise(F.col("_line")))
    kept = feed.records.select(F.lit("read").alias("reject_reason"))
    return kept.unionByName(feed.rejects.select("reject_reason")).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


def _import_lines(spark, sf):
    lines = user_lines(_heavy(spark, sf, "lineitem")).select("_line", "_ingest_order")
    return imports.import_users(spark, split_lines(lines, USERS_COLUMNS))


def q_feed_import_rejects(spark, sf):
    """Keys that are no numbers; every other record loads or is checked on."""
    rej = _import_lines(spark, sf)["rejects"].where("table = 'users'")
    return rej.groupBy("key", "reject_reason").agg(F.count(F.lit(1)).alias("n"))


def q_feed_import_edges(spark, sf):
    """Blank list cells give no edge; loaded users at both ends."""
    return _import_lines(spark, sf)["user_followers"].drop("id")


# ============================================================== C7 on cells made of known items
def q_split_quoted_items(spark, sf):
    """Items with commas inside both kinds of quotes, an escaped quote, blanks, an empty item and
    an unclosed quote that runs to the end of the cell."""
    p = _t(spark, sf, "part")
    s = lambda c: F.col(c).cast("string")
    compat = F.concat(F.lit(" "), s("p_partkey"), F.lit(",'it, "), F.col("p_brand"), F.lit("',, \"a,b "), s("p_size"),
                      F.lit("\" ,x\\\"y,'end, "), F.col("p_name"))
    repaired = F.concat(F.lit("don't "), s("p_partkey"), F.lit(",\"p, \\\"q, "), F.col("p_brand"), F.lit("\",\t,z\\,w "), s("p_size"),
                        F.lit(",\"end, "), F.col("p_name"))
    cells = p.select("p_partkey", F.explode(F.array(
        F.struct(F.lit("compat").alias("mode"), fx.split_quoted(compat, compat=True).alias("items")),
        F.struct(F.lit("repaired").alias("mode"), fx.split_quoted(repaired, compat=False).alias("items")))).alias("c"))
    return cells.select("p_partkey", "c.mode", F.posexplode("c.items").alias("pos", "item"))


# ============================================================== C14 K14 A11
def q_cut_text(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", fx.cut("text", 255).alias("text"))


def q_surrogate_id(spark, sf):
    ids = flatten.with_surrogate_id(_t(spark, sf, "lineitem"), "id")
    return ids.agg(F.count("id").alias("rows"), F.count_distinct("id").alias("ids"), F.count_if(F.col("id") < 0).alias("negative"))


def q_timing_summary(spark, sf):
    """Events as timed operations: the mean of each kind, and its ratio to that of ``click``."""
    out = reports.timing_summary(_t(spark, sf, "events"), "event_type", "value", base_op="click")
    return out.select("event_type", _r("mean_ms"), "rounds", _r("ratio"))


# ============================================================== C6 C8 as the feeds' first reader had them
def q_parse_ids_compat(spark, sf):
    p = _t(spark, sf, "part")
    cell = F.concat(F.lit("c("), F.col("p_size").cast("string"), F.lit(", "), F.col("p_partkey").cast("string"), F.lit(", "),
                    F.col("p_size").cast("string"), F.lit(")"))
    return p.select("p_partkey", F.explode(fx.parse_ids(cell, compat=True)).alias("id"))


def q_parse_strs_compat(spark, sf):
    p = _t(spark, sf, "part")
    return p.select("p_partkey", F.explode(fx.parse_strs(_brand_cell(p), compat=True)).alias("item"))


# ============================================================== G2 / G3 imports on derived feeds
def recipes_feed_rows(li: DataFrame) -> DataFrame:
    """A raw recipes feed (27 text cells) with one record per lineitem row; the key
    (l_orderkey) repeats, "first" is the lineitem order."""
    s = lambda c: F.col(c).cast("string")
    lit = F.lit
    calories = F.when(F.col("l_linestatus") == "O", F.concat(lit("-"), s("l_partkey"), lit(".5"))) \
        .otherwise(F.concat(s("l_partkey"), lit(".5")))
    cells = [
        s("l_orderkey"), F.concat(lit("Recipe "), s("l_orderkey")), s("l_suppkey"), lit("Chef"),
        F.concat(lit("PT"), s("l_linenumber"), lit("M")), lit(None).cast("string"), lit("PT1H"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.concat(lit("Line "), s("l_linenumber"), lit(" of "), s("l_orderkey")), s("l_returnflag"),
        F.concat(lit('c("'), s("l_returnflag"), lit('", "'), s("l_linestatus"), lit(', x")')),
        F.concat(lit('c("part '), s("l_partkey"), lit('", "supp '), s("l_suppkey"), lit('")')),
        F.concat((F.col("l_linenumber") - 1).cast("string"), lit("."), s("l_linenumber")),
        s("l_quantity"), calories,
        *[s("l_linenumber")] * 8,
        (F.col("l_linenumber") - 1).cast("string"), s("l_linestatus"),
        F.concat(lit('c("cut '), s("l_partkey"), lit('", "", "cook, '), s("l_suppkey"), lit(' min")')),
        F.concat(lit('c("'), s("l_suppkey"), lit('", "'), s("l_partkey"), lit('")')),
    ]
    return li.select(*cells, F.struct("l_orderkey", "l_linenumber").alias("_ingest_order")) \
        .toDF(*RECIPES_COLUMNS, "_ingest_order")


def _import_recipes(spark, sf):
    rows = recipes_feed_rows(_heavy(spark, sf, "lineitem"))
    return imports.import_recipes(spark, from_rows(rows, RECIPES_COLUMNS + ["_ingest_order"]),
                                  persist=True)


def q_import_metrics(spark, sf):
    return _import_users(spark, sf)["metrics"]


def q_import_recipes(spark, sf):
    r = _import_recipes(spark, sf)["recipes"]
    return r.withColumn("favorite_users", F.array_join("favorite_users", "|"))


def q_import_keywords(spark, sf):
    return _import_recipes(spark, sf)["keywords"].drop("keyword_id")


def q_import_ingredients(spark, sf):
    return _import_recipes(spark, sf)["recipe_ingredients"].drop("ingredient_id")


def q_import_instructions(spark, sf):
    return _import_recipes(spark, sf)["recipe_instructions"].drop("instruction_id")


def q_import_recipe_rejects(spark, sf):
    rej = _import_recipes(spark, sf)["rejects"]
    return rej.groupBy("table", "reject_reason").agg(F.count(F.lit(1)).alias("n"))


def reviews_feed_rows(orders: DataFrame) -> DataFrame:
    """A raw reviews feed (9 text cells), one record per order, keyed by customer."""
    s = lambda c: F.col(c).cast("string")
    lit = F.lit
    prio = F.substring("o_orderpriority", 1, 1).cast("int")
    cells = [
        s("o_custkey"), s("o_orderkey"),
        F.when(F.col("o_orderstatus") == "P", lit("")).otherwise(s("o_custkey")), lit("Critic"),
        F.concat((prio + 2).cast("string"), lit(".9")), s("o_orderstatus"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.concat(s("o_custkey"), lit(", "), s("o_orderkey"), lit(",x,,"), s("o_custkey")),
    ]
    return orders.select(*cells, F.struct("o_orderkey").alias("_ingest_order")) \
        .toDF(*REVIEWS_COLUMNS, "_ingest_order")


def _import_reviews(spark, sf):
    rows = reviews_feed_rows(_heavy(spark, sf, "orders"))
    return imports.import_reviews(spark, from_rows(rows, REVIEWS_COLUMNS + ["_ingest_order"]),
                                  persist=True)


def q_import_reviews(spark, sf):
    return _import_reviews(spark, sf)["reviews"]


def q_import_likers(spark, sf):
    return _import_reviews(spark, sf)["review_likers"].drop("like_id")


def q_import_review_rejects(spark, sf):
    rej = _import_reviews(spark, sf)["rejects"]
    return rej.groupBy("table", "reject_reason").agg(F.count(F.lit(1)).alias("n"))


# ============================================================== K14 over loads, K1, A8 by partition
def _halves(spark, sf):
    li, cutoff = _t(spark, sf, "lineitem"), F.lit(LOAD_CUTOFF).cast("timestamp")
    return li.filter(F.col("l_shipdate") < cutoff), li.filter(F.col("l_shipdate") >= cutoff)


def q_surrogate_id_loads(spark, sf):
    """Two loads into one table: the second goes on where the first ended."""
    target, edges = shared_path(spark, "edges"), ("l_partkey", "l_suppkey")
    for half in _halves(spark, sf):
        unit = ledger.begin(spark, target, "users")
        pairs = half.select(F.lit(None).cast("long").alias("id"), *[F.col(c).cast("int").alias(n) for c, n in zip(edges, ("user_id", "follower_id"))])
        n, after = ledger.write_with_ids(pairs, target, "user_followers", unit, "id")
        ledger.commit(spark, target, unit, [("user_followers", "loaded", n, after)])
    rows = ledger.committed(spark, target, "user_followers", TARGETS["user_followers"])
    return rows.agg(F.count("id").alias("rows"), F.count_distinct("id").alias("ids"), F.min("id").alias("first"), F.max("id").alias("last"),
                    F.count_distinct(ledger.LOAD).alias("loads"))


def q_load_report(spark, sf):
    """A9 of two committed loads and one that broke off before its record."""
    target = shared_path(spark, "loads")
    for half, done in zip((*_halves(spark, sf), _t(spark, sf, "lineitem")), (True, True, False)):
        unit = ledger.begin(spark, target, "users")
        n = ledger.write(half.select(F.col("l_partkey").cast("int").alias("author_id")), target, "users", unit)
        if done:
            ledger.commit(spark, target, unit, [("users", "loaded", n, None)])
    return ledger.report(spark, target).select("load_id", "table", "stage", "rows")


def q_import_partition_metrics(spark, sf):
    """A8 by scan partition, summed up: each chunk's counts come from the one pass over the feed."""
    parts = _import_users(spark, sf)["partition_metrics"]
    return metrics.totals(parts)


# ============================================================== K2 K4 K13 on bucketed layouts
def q_keep_first_bucketed(spark, sf):
    """K2 against keys in a bucketed index: the rows that a load adds."""
    old, new = _halves(spark, sf)
    index, path = _index_name("keys"), shared_path(spark, "keys")
    upsert.write_index(old, index, KEYS, buckets=8, path=path)
    out = upsert.without(upsert.keep_first(new, KEYS), spark.table(index), KEYS)
    spark.sql(f"DROP TABLE {index}")  # the name alone: the files stay, and ``out`` reads them
    return out


def _index_name(name: str) -> str:
    return f"feedworks_{name}_{uuid.uuid4().hex}"


def q_lookup_bucketed(spark, sf):
    """The lines of the dearest part from a table bucketed by part."""
    key = _t(spark, sf, "part").orderBy(F.desc("p_retailprice"), "p_partkey").select("p_partkey").first()[0]
    index = _index_name("lines")
    sinks.write_bucketed(_t(spark, sf, "lineitem"), index, "l_partkey", 8, path=shared_path(spark, "lines"))
    out = sinks.lookup(spark.table(index), "l_partkey", [key])
    spark.sql(f"DROP TABLE {index}")
    return out


# ============================================================== U1 U3 U4 Q14 on stored tables
def _stored(spark, sf, name, key, width=500):
    path = shared_path(spark, name)
    stored.write_ranged(_t(spark, sf, name), path, key, width)
    return path


def q_stored_update(spark, sf):
    path = _stored(spark, sf, "part", "p_partkey")
    n = stored.update(spark, path, "p_retailprice", F.col("p_retailprice") + 1, F.col("p_size") < 30)
    return stored.read_ranged(spark, path).select("p_partkey", "p_size", "p_retailprice", F.lit(n).cast("long").alias("changed"))


def q_stored_delete(spark, sf):
    path = _stored(spark, sf, "part", "p_partkey")
    stored.delete(spark, path, F.coalesce(F.col("p_size"), F.lit(0)) > 40)
    return stored.read_ranged(spark, path)


def q_stored_delete_in_limit(spark, sf):
    path = _stored(spark, sf, "part", "p_partkey")
    stored.delete_in_limit(spark, path, "p_partkey", 500, F.col("p_size") > 45, 10)
    return stored.read_ranged(spark, path)


def q_stored_cascade(spark, sf):
    """Urgent orders and their lines, both stored by ranges of the order's key."""
    orders, lines = _stored(spark, sf, "orders", "o_orderkey", 5000), _stored(spark, sf, "lineitem", "l_orderkey", 5000)
    doomed = _t(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    gone = stored.cascade_delete(spark, orders, "o_orderkey", 5000, doomed, [(lines, "l_orderkey", 5000)])
    return stored.read_ranged(spark, lines).withColumn("orders_deleted", F.lit(gone[orders]).cast("long"))


# ============================================================== S1 S3 with newlines in cells; marks
def q_feed_marks(spark, sf):
    """Private-use characters and backslashes in a cell come back as they were."""
    odd = F.concat(F.lit('"Ann \ue000 \ue001 \ue0010 \\\\ Lee '), F.col("l_suppkey").cast("string"), F.lit('"'))
    li = _t(spark, sf, "lineitem").select(F.concat(F.col("l_partkey").cast("string"), F.lit(","), odd, F.lit(",Male,1,1,1,,")).alias("_line"),
                                          "l_orderkey", "l_linenumber")
    return split_lines(li, USERS_COLUMNS).records.select("author_id", "author_name", "gender", "l_orderkey", "l_linenumber")


def q_feed_multi_line(spark, sf):
    """Users with a newline, a doubled quote and a blank line in the name, written as CSV text of
    several files and read by many tasks."""
    path = shared_path(spark, "feed")
    s = lambda c: F.col(c).cast("string")
    name = F.concat(F.lit('"Ann ""the\n\n'), s("l_suppkey"), F.lit('""\nLee, "'))
    line = F.concat_ws(",", s("l_partkey"), name, F.lit("Male"), s("l_linenumber"), s("l_orderkey"), F.lit("1"), F.lit(""), F.lit(""))
    # every file begins with its header
    _t(spark, sf, "lineitem").repartitionByRange(4, "l_orderkey").select(line.alias("value")).write \
        .option("header", True).option("quote", "").option("escape", "").option("escapeQuotes", False).option("sep", "\u0001").csv(path)
    feed = read_records(spark, path, USERS_COLUMNS, ingest_order=False)
    return feed.records.select("author_id", "author_name", "gender", "age", "followers_count")


QUERIES = {
    "count_all": q_count_all,
    "filter_counts": q_filter_counts,
    "filter_between": q_filter_between,
    "filter_greater": q_filter_greater,
    "filter_equals": q_filter_equals,
    "filter_any_case": q_filter_any_case,
    "group_having_sort": q_group_having_sort,
    "left_join_distinct": q_left_join_distinct,
    "decade_average": q_decade_average,
    "global_stats": q_global_stats,
    "above_global_avg": q_above_global_avg,
    "update_where": q_update_where,
    "update_count": q_update_count,
    "delete_in_limit": q_delete_in_limit,
    "delete_where": q_delete_where,
    "suite_deleted": q_suite_deleted,
    "suite_grouped": q_suite_grouped,
    "suite_joined": q_suite_joined,
    "file_suite_bands": q_file_suite_bands,
    "file_suite_high_female": q_file_suite_high_female,
    "conditional_summary": q_conditional_summary,
    "keep_first": q_keep_first,
    "keep_first_existing": q_keep_first_existing,
    "edge_dedup": q_edge_dedup,
    "edge_no_self": q_edge_no_self,
    "drop_columns": q_drop_columns,
    "fk_valid": q_fk_valid,
    "fk_rejects": q_fk_rejects,
    "cascade_delete": q_cascade_delete,
    "clean_int": q_clean_int,
    "int_or_zero": q_int_or_zero,
    "clean_str": q_clean_str,
    "clean_double_round": q_clean_double_round,
    "clean_decimal": q_clean_decimal,
    "clean_instant_date": q_clean_instant_date,
    "decade_label": q_decade_label,
    "normalize_list": q_normalize_list,
    "explode_keywords": q_explode_keywords,
    "explode_ingredients": q_explode_ingredients,
    "parse_steps": q_parse_steps,
    "split_quoted_compat": q_split_quoted_compat,
    "explode_likers": q_explode_likers,
    "quality_counts": q_quality_counts,
    "quality_rejects": q_quality_rejects,
    "quality_valid": q_quality_valid,
    "import_users": q_import_users,
    "import_followers": q_import_followers,
    "import_following": q_import_following,
    "import_rejects": q_import_rejects,
    "import_metrics": q_import_metrics,
    "import_recipes": q_import_recipes,
    "import_keywords": q_import_keywords,
    "import_ingredients": q_import_ingredients,
    "import_instructions": q_import_instructions,
    "import_recipe_rejects": q_import_recipe_rejects,
    "import_reviews": q_import_reviews,
    "import_likers": q_import_likers,
    "import_review_rejects": q_import_review_rejects,
    "feed_lines": q_feed_lines,
    "feed_short": q_feed_short,
    "feed_escaped": q_feed_escaped,
    "feed_unterminated": q_feed_unterminated,
    "feed_import_rejects": q_feed_import_rejects,
    "feed_import_edges": q_feed_import_edges,
    "split_quoted_items": q_split_quoted_items,
    "cut_text": q_cut_text,
    "surrogate_id": q_surrogate_id,
    "timing_summary": q_timing_summary,
    "parse_ids_compat": q_parse_ids_compat,
    "parse_strs_compat": q_parse_strs_compat,
    "surrogate_id_loads": q_surrogate_id_loads,
    "load_report": q_load_report,
    "import_partition_metrics": q_import_partition_metrics,
    "keep_first_bucketed": q_keep_first_bucketed,
    "lookup_bucketed": q_lookup_bucketed,
    "stored_update": q_stored_update,
    "stored_delete": q_stored_delete,
    "stored_delete_in_limit": q_stored_delete_in_limit,
    "stored_cascade": q_stored_cascade,
    "feed_marks": q_feed_marks,
    "feed_multi_line": q_feed_multi_line,
}
