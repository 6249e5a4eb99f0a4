"""DuckDB statements that compute the catalogue's results independently.

They restate each operator's rule in plain SQL over the same Parquet tables
(DuckDB's regex engine is RE2, so the quote-aware item pattern is written without
possessive quantifiers; with these patterns the matches are the same).
"""

from __future__ import annotations

from feedworks.plans.catalogue import DOUBLE_CELLS, INT_CELLS, LOAD_CUTOFF

# --------------------------------------------------------------------------- helpers
RE2_ITEM = r'(?:[^,"\\]|\\.?|"(?:[^"\\]|\\.?)*(?:"|$))+'
RE2_ITEM_COMPAT = (r'''(?:[^,"''\\]|\\["'']?|"(?:[^"\\]|\\"?)*(?:"|$)|'''
                   r"""''(?:[^''\\]|\\''?)*(?:''|$))+""")


def jt(x: str) -> str:
    return "regexp_replace(" + x + r", '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


def safe_str(x: str, n: int = 200) -> str:
    t = jt(x)
    return f"(CASE WHEN {t} = '' OR lower({t}) = 'null' THEN NULL ELSE substr({t}, 1, {n}) END)"


def d2i(d: str) -> str:
    return (f"(CASE WHEN {d} IS NULL THEN NULL WHEN isnan({d}) THEN 0 ELSE "
            f"CAST(trunc(greatest(least({d}, 2147483647), -2147483648)) AS INTEGER) END)")


def safe_int(x: str) -> str:
    t = jt(x)
    d = f"try_cast({t} AS DOUBLE)"
    return (f"(CASE WHEN {t} = '' THEN NULL "
            f"WHEN regexp_full_match({t}, '[+-]?[0-9]+') THEN try_cast({t} AS INTEGER) "
            f"WHEN contains({t}, '.') THEN {d2i(d)} END)")


def int_or_zero(x: str) -> str:
    t = jt(x)
    return (f"coalesce(CASE WHEN regexp_full_match({t}, '[+-]?[0-9]+') "
            f"THEN try_cast({t} AS INTEGER) END, 0)")


def safe_double(x: str) -> str:
    t = jt(x)
    return f"(CASE WHEN {t} = '' THEN NULL ELSE try_cast({t} AS DOUBLE) END)"


def keep_first_sql(src: str, keys: list[str], order: list[str], cols: list[str]) -> str:
    ob = ", ".join(f"{c} ASC NULLS FIRST" for c in order)
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER (PARTITION BY "
            f"{', '.join(keys)} ORDER BY {ob}) AS rn__ FROM {src}) WHERE rn__ = 1")


def unwrap(t: str) -> str:
    return (rf"(CASE WHEN regexp_full_match({t}, '(?s)(?:c\(.*\)|\[.*\])') "
            rf"THEN regexp_replace({t}, '^(?:c\(|\[)|[)\]]$', '', 'g') ELSE {t} END)")


def strip_quotes(x: str) -> str:
    y = f"regexp_replace({x}, '^\"', '')"
    y = (f"(CASE WHEN suffix({y}, '\"') AND NOT suffix({y}, '\\\"') "
         f"THEN left({y}, length({y}) - 1) ELSE {y} END)")
    return f"replace({y}, '\\\"', '\"')"


def split_items(x: str, compat: bool) -> str:
    rx = RE2_ITEM_COMPAT if compat else RE2_ITEM
    return (f"list_filter(list_transform(regexp_extract_all({x}, '{rx}'), "
            f"lambda i: {jt('i')}), lambda i: i <> '')")


def parse_strs(x: str) -> str:
    t = jt(x)
    items = split_items(unwrap(t), compat=False)
    cleaned = f"list_filter(list_transform({items}, lambda s: {safe_str(strip_quotes('s'))}), lambda s: s IS NOT NULL)"
    return f"(CASE WHEN {t} IS NULL OR {t} = '' OR {t} IN ('null', 'NULL') THEN []::VARCHAR[] ELSE {cleaned} END)"


def parse_ids(x: str) -> str:
    t = jt(x)
    body = f"regexp_replace({unwrap(t)}, '[\"'']', '', 'g')"
    ids = f"list_filter(list_transform(string_split({body}, ','), lambda v: {safe_int('v')}), lambda v: v IS NOT NULL)"
    return f"(CASE WHEN {t} IS NULL OR {t} = '' OR {t} IN ('null', 'NULL') THEN []::INTEGER[] ELSE {ids} END)"


def normalize_list(x: str) -> str:
    s = rf"""regexp_replace(replace(regexp_replace({x}, '^c\(|\)$', '', 'g'), '"', ''), '\s+', ' ', 'g')"""
    return (f"coalesce(list_filter(list_transform(string_split({jt(s)}, ','), lambda z: {jt('z')}), "
            f"lambda z: z <> ''), []::VARCHAR[])")


def normalize_list_text(x: str) -> str:
    return ("'[' || array_to_string(list_transform(" + normalize_list(x) +
            ", lambda q: '\"' || q || '\"'), ',') || ']'")


LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
             "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LINE_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]
KEYS = ["l_orderkey", "l_linenumber"]
BRAND_CELL = """('c("' || p_brand || '", "' || p_type || ', ' || p_name || '")')"""

# Part as the users analogue after the suite's update (price + 1 where size < 30) and
# delete (first 10 keys with size > 45).
PART_UPDATED = ("SELECT p_partkey, p_name, p_type, p_size, CASE WHEN p_size < 30 "
                "THEN p_retailprice + 1 ELSE p_retailprice END AS p_retailprice FROM part")
PART_AFTER = (f"SELECT * FROM ({PART_UPDATED}) WHERE p_partkey NOT IN (SELECT p_partkey FROM part "
              f"WHERE p_size > 45 ORDER BY p_partkey LIMIT 10)")
FILE_UPDATED = ("SELECT p_partkey, p_type, coalesce(p_size, 0) AS age, CASE WHEN coalesce(p_size, 0) < 30 "
                "THEN p_retailprice + 1 ELSE p_retailprice END AS p_retailprice FROM part")
FILE_REMAINING = f"SELECT * FROM ({FILE_UPDATED}) WHERE NOT (age > 45)"
FEMALE = "coalesce(lower(p_type) IN ('economy', 'e'), false)"

USERS_RAW = f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  {safe_int("CAST(l_partkey AS VARCHAR)")} AS author_id,
  {safe_str("'User ' || CAST(l_partkey AS VARCHAR)")} AS author_name,
  CASE l_returnflag WHEN 'R' THEN 'Female' WHEN 'A' THEN 'Male' ELSE 'Other' END AS gender,
  {safe_int("CAST(l_quantity AS VARCHAR)")} AS age,
  {safe_int("CAST(l_suppkey AS VARCHAR)")} AS followers_count,
  {safe_int("CAST(l_linenumber AS VARCHAR)")} AS following_count,
  CAST(l_partkey + 1 AS VARCHAR) || ', ' || CAST(l_partkey AS VARCHAR) || ',x' AS fol_cell,
  CAST(l_partkey AS VARCHAR) || ',' || CAST(l_partkey + 7 AS VARCHAR) AS ing_cell
FROM lineitem"""
USERS_LOADED = f"""SELECT author_id, author_name, gender, age, followers_count, following_count FROM (
  SELECT *, row_number() OVER (PARTITION BY author_id ORDER BY l_orderkey, l_linenumber,
      author_name NULLS FIRST, gender NULLS FIRST, age NULLS FIRST, followers_count NULLS FIRST,
      following_count NULLS FIRST) AS rn
  FROM ({USERS_RAW}) WHERE author_id IS NOT NULL AND gender IN ('Male', 'Female')) WHERE rn = 1"""
FOL_EDGES = f"""SELECT author_id AS user_id, unnest({parse_ids('fol_cell')}) AS follower_id
  FROM ({USERS_RAW}) WHERE author_id IS NOT NULL"""
ING_EDGES = f"""SELECT * FROM (SELECT author_id AS user_id, unnest({parse_ids('ing_cell')}) AS following_id
  FROM ({USERS_RAW}) WHERE author_id IS NOT NULL) WHERE following_id <> user_id"""


def _fk_tag(edges: str, other: str) -> str:
    return (f"SELECT *, CASE WHEN user_id NOT IN (SELECT author_id FROM ({USERS_LOADED})) THEN 'fk:user_id' "
            f"WHEN {other} NOT IN (SELECT author_id FROM ({USERS_LOADED})) THEN 'fk:{other}' END AS reason "
            f"FROM ({edges})")


ORPHANED = """SELECT * REPLACE (CASE WHEN o_custkey % 5 = 0 THEN o_custkey + 100000000 ELSE o_custkey END AS o_custkey)
    FROM orders"""
LONE_PARTS = "SELECT * REPLACE (CASE WHEN p_partkey % 3 = 0 THEN -p_partkey ELSE p_partkey END AS p_partkey) FROM part"

ORACLE = {
    "count_all": "SELECT count(*) AS n FROM part",
    "filter_counts": """SELECT count(*) AS total,
        count(*) FILTER (WHERE p_size BETWEEN 25 AND 35) AS age_in_range,
        count(*) FILTER (WHERE p_retailprice > 950) AS followers_over,
        count(*) FILTER (WHERE p_type = 'ECONOMY') AS gender_match FROM part""",
    "filter_between": "SELECT p_partkey, p_name, p_size FROM part WHERE p_size BETWEEN 25 AND 35",
    "filter_greater": "SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice > 950",
    "filter_equals": "SELECT p_partkey, p_type FROM part WHERE p_type = 'ECONOMY'",
    "filter_any_case": ("SELECT c_custkey, c_mktsegment FROM customer "
                        "WHERE lower(c_mktsegment) IN ('building', 'b')"),
    "group_having_sort": """SELECT p_type, round(avg(p_retailprice), 6) AS avg_followers,
        round(avg(p_size), 6) AS avg_following, count(*) AS count FROM part
        WHERE p_size BETWEEN 20 AND 40 GROUP BY p_type HAVING count(*) > 10
        ORDER BY avg_followers DESC""",
    "left_join_distinct": f"""SELECT u.p_type, count(DISTINCT e.l_suppkey) AS unique_followers,
        round(avg(u.p_retailprice), 6) AS avg_followers
        FROM ({LONE_PARTS}) u LEFT JOIN (SELECT * FROM lineitem ) e ON u.p_partkey = e.l_partkey
        WHERE u.p_size BETWEEN 18 AND 60 GROUP BY u.p_type
        HAVING count(DISTINCT e.l_suppkey) > 0 ORDER BY unique_followers DESC""",
    "decade_average": """SELECT CAST(p_size - p_size % 10 AS INTEGER) AS age_group,
        round(avg(p_retailprice), 6) AS avg_followers, count(*) AS n FROM part GROUP BY 1""",
    "global_stats": "SELECT round(sum(c_acctbal), 2) AS total, round(avg(c_acctbal), 6) AS mean FROM customer",
    "above_global_avg": """SELECT c_custkey, c_name, c_acctbal FROM customer
        WHERE lower(c_mktsegment) IN ('building', 'b')
          AND c_acctbal > (SELECT avg(c_acctbal) FROM customer)""",
    "update_where": """SELECT p_partkey, p_size, CASE WHEN p_size < 30 THEN p_retailprice + 1
        ELSE p_retailprice END AS p_retailprice FROM part""",
    "update_count": "SELECT count(*) AS updated FROM part WHERE p_size < 30",
    "delete_in_limit": """SELECT * FROM part WHERE p_partkey NOT IN
        (SELECT p_partkey FROM part WHERE p_size > 45 ORDER BY p_partkey LIMIT 10)""",
    "delete_where": "SELECT * FROM part WHERE NOT (coalesce(p_size, 0) > 40)",
    "suite_deleted": ("SELECT count(*) AS deleted FROM (SELECT p_partkey FROM part WHERE p_size > 45 "
                      "ORDER BY p_partkey LIMIT 10)"),
    "suite_grouped": f"""SELECT p_type, round(avg(p_retailprice), 6) AS avg_followers,
        round(avg(p_size), 6) AS avg_following, count(*) AS count FROM ({PART_AFTER})
        WHERE p_size BETWEEN 20 AND 40 GROUP BY p_type HAVING count(*) > 10""",
    "suite_joined": f"""SELECT u.p_type, count(DISTINCT e.l_suppkey) AS unique_followers,
        round(avg(u.p_retailprice), 6) AS avg_followers
        FROM ({PART_AFTER}) u LEFT JOIN lineitem e ON u.p_partkey = e.l_partkey
        WHERE u.p_size BETWEEN 18 AND 60 GROUP BY u.p_type HAVING count(DISTINCT e.l_suppkey) > 0""",
    "file_suite_bands": f"""SELECT CAST(age - age % 10 AS INTEGER) AS age_group,
        round(avg(p_retailprice), 6) AS avg_followers FROM ({FILE_REMAINING}) GROUP BY 1""",
    "file_suite_high_female": f"""SELECT p_partkey, p_type, p_retailprice FROM ({FILE_REMAINING})
        WHERE {FEMALE} AND p_retailprice > (SELECT avg(p_retailprice) FROM ({FILE_REMAINING}))""",
    "conditional_summary": f"""SELECT
        (SELECT count(*) FROM part WHERE coalesce(p_size, 0) BETWEEN 25 AND 35) AS age_in_range,
        (SELECT count(*) FROM part WHERE p_retailprice > 950) AS followers_over,
        (SELECT count(*) FROM part WHERE {FEMALE}) AS female,
        (SELECT count(*) FROM part WHERE coalesce(p_size, 0) < 30) AS updated,
        (SELECT count(*) FROM part WHERE coalesce(p_size, 0) > 45) AS deleted,
        (SELECT count(*) FROM ({FILE_REMAINING})) AS remaining_users,
        (SELECT count(*) FROM ({FILE_REMAINING}) WHERE {FEMALE} AND p_retailprice >
            (SELECT avg(p_retailprice) FROM ({FILE_REMAINING}))) AS high_follower_female""",
    "keep_first": keep_first_sql("lineitem", KEYS, LINE_REST, LINE_COLS),
    "keep_first_existing": f"""WITH e AS ({keep_first_sql(
            "(SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1997-01-01')", KEYS, LINE_REST, LINE_COLS)}),
        n AS ({keep_first_sql(
            "(SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01')", KEYS, LINE_REST, LINE_COLS)})
        SELECT * FROM e UNION ALL SELECT * FROM n WHERE NOT EXISTS
        (SELECT 1 FROM e WHERE e.l_orderkey = n.l_orderkey AND e.l_linenumber = n.l_linenumber)""",
    "edge_dedup": f"""SELECT DISTINCT user_id, follower_id FROM (
        SELECT CAST(l_orderkey AS INTEGER) AS user_id, unnest({parse_ids(
            "CAST(l_suppkey AS VARCHAR) || ', ' || CAST(l_partkey AS VARCHAR) || ',x,,' || CAST(l_suppkey AS VARCHAR)")})
            AS follower_id FROM lineitem)""",
    "edge_no_self": f"""SELECT DISTINCT user_id, following_id FROM (
        SELECT CAST(l_suppkey AS INTEGER) AS user_id, unnest({parse_ids(
            "CAST(l_partkey AS VARCHAR) || ',' || CAST(l_suppkey AS VARCHAR)")}) AS following_id
        FROM lineitem) WHERE following_id <> user_id""",
    "drop_columns": "SELECT p_partkey, p_type, p_size, p_retailprice FROM part",
    "fk_valid": f"""SELECT * FROM ({ORPHANED}) o WHERE o.o_custkey IS NULL OR EXISTS
        (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)""",
    "fk_rejects": f"""SELECT *, 'fk:o_custkey' AS reject_reason FROM ({ORPHANED}) o
        WHERE o.o_custkey IS NOT NULL AND NOT EXISTS
        (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)""",
    "cascade_delete": """SELECT * FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o
        WHERE o.o_orderkey = l.l_orderkey AND o.o_orderpriority = '1-URGENT')""",
    "clean_str": f"""SELECT doc_id, {safe_str('text')} AS text_clean,
        coalesce(CASE WHEN lower(source) <> 'null' THEN {jt('source')} END, '') AS source_clean,
        ({safe_str('text')} IS NULL OR length({safe_str('text')}) <= 100) AS fits_100 FROM documents""",
    "clean_decimal": f"""SELECT c_custkey,
        try_cast({safe_double("CAST(c_acctbal AS VARCHAR)")} / 1000.0 AS DECIMAL(3,1)) AS rating FROM customer""",
    "clean_instant_date": """SELECT event_id, CAST(ts AS DATE) AS d_z, CAST(ts AS DATE) AS d_offset,
        CAST(NULL AS DATE) AS d_date_only, CAST(NULL AS DATE) AS d_padded FROM events""",
    "decade_label": """SELECT p_partkey, CAST(p_size - p_size % 10 AS INTEGER) AS age_group,
        CAST(p_size - p_size % 10 AS VARCHAR) || '-' || CAST(p_size - p_size % 10 + 9 AS VARCHAR) AS label,
        round(p_retailprice / 3, 2) AS third FROM part""",
    "normalize_list": f"SELECT p_partkey, {normalize_list_text(BRAND_CELL)} AS favorite_users FROM part",
    "explode_keywords": f"SELECT p_partkey, unnest({parse_strs(BRAND_CELL)}) AS keyword_text FROM part",
    "explode_ingredients": f"""SELECT p_partkey, unnest(list_filter(list_transform({normalize_list(BRAND_CELL)},
        lambda g: {jt(safe_str('g'))}), lambda g: g IS NOT NULL AND g <> '')) AS ingredient_text FROM part""",
    "parse_steps": f"""WITH a AS (SELECT doc_id, list_filter(list_transform({parse_strs('text')},
            lambda s: {jt('s')}), lambda s: s <> '') AS l FROM documents)
        SELECT doc_id, CAST(i AS INTEGER) AS step_order, l[i] AS instruction_text
        FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM a)""",
    "split_quoted_compat": f"SELECT doc_id, unnest({split_items('text', compat=True)}) AS item FROM documents",
    "explode_likers": f"""SELECT CAST(event_id AS INTEGER) AS review_id, unnest({parse_ids(
        "'[' || CAST(user_id AS VARCHAR) || ', ' || CAST(user_id AS VARCHAR) || ',null]'")}) AS liker_id FROM events""",
    "quality_counts": """WITH c AS (SELECT *, try_cast(c_acctbal / 100.0 AS DECIMAL(3,1)) AS rating FROM customer)
        SELECT 'not_null:c_name' AS rule, count(*) FILTER (WHERE c_name IS NULL) AS failed FROM c
        UNION ALL SELECT 'max_length:c_mktsegment', count(*) FILTER (WHERE length(c_mktsegment) > 9) FROM c
        UNION ALL SELECT 'in_set:c_mktsegment', count(*) FILTER (WHERE c_mktsegment NOT IN
            ('BUILDING', 'AUTOMOBILE', 'MACHINERY', 'HOUSEHOLD')) FROM c
        UNION ALL SELECT 'range:c_acctbal', count(*) FILTER (WHERE c_acctbal < 0 OR c_acctbal > 9000) FROM c
        UNION ALL SELECT 'fits:rating', count(*) FILTER (WHERE c_acctbal IS NOT NULL AND rating IS NULL) FROM c""",
    "quality_rejects": """WITH c AS (SELECT *, try_cast(c_acctbal / 100.0 AS DECIMAL(3,1)) AS rating FROM customer),
        t AS (SELECT c_custkey, CASE WHEN c_name IS NULL THEN 'not_null:c_name'
            WHEN length(c_mktsegment) > 9 THEN 'max_length:c_mktsegment'
            WHEN c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY', 'HOUSEHOLD') THEN 'in_set:c_mktsegment'
            WHEN c_acctbal < 0 OR c_acctbal > 9000 THEN 'range:c_acctbal'
            WHEN c_acctbal IS NOT NULL AND rating IS NULL THEN 'fits:rating' END AS reject_reason FROM c)
        SELECT * FROM t WHERE reject_reason IS NOT NULL""",
    "quality_valid": """WITH c AS (SELECT *, try_cast(c_acctbal / 100.0 AS DECIMAL(3,1)) AS rating FROM customer)
        SELECT c_custkey, c_mktsegment, c_acctbal, rating FROM c
        WHERE c_name IS NOT NULL AND NOT coalesce(length(c_mktsegment) > 9, false)
          AND NOT coalesce(c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY', 'HOUSEHOLD'), false)
          AND NOT coalesce(c_acctbal < 0 OR c_acctbal > 9000, false)
          AND NOT (c_acctbal IS NOT NULL AND rating IS NULL)""",
    "import_users": USERS_LOADED,
    "import_followers": f"""SELECT DISTINCT user_id, follower_id FROM ({_fk_tag(FOL_EDGES, 'follower_id')})
        WHERE reason IS NULL""",
    "import_following": f"""SELECT DISTINCT user_id, following_id FROM ({_fk_tag(ING_EDGES, 'following_id')})
        WHERE reason IS NULL""",
    "import_rejects": f"""SELECT "table", reject_reason, count(*) AS n FROM (
        SELECT 'users' AS "table", CASE WHEN author_id IS NULL THEN 'bad_key:author_id'
            WHEN gender NOT IN ('Male', 'Female') THEN 'in_set:gender' END AS reject_reason FROM ({USERS_RAW})
        UNION ALL SELECT 'user_followers', reason FROM ({_fk_tag(FOL_EDGES, 'follower_id')})
        UNION ALL SELECT 'user_following', reason FROM ({_fk_tag(ING_EDGES, 'following_id')}))
        WHERE reject_reason IS NOT NULL GROUP BY 1, 2""",
}

_int_sel = ", ".join(f"{safe_int(c)} AS {c}" for c in INT_CELLS)
_zero_sel = ", ".join(f"{int_or_zero(c)} AS {c}" for c in INT_CELLS)
INT_CELLS_SQL = """SELECT l_orderkey, l_linenumber,
    ' ' || CAST(l_suppkey AS VARCHAR) || ' ' AS a_pad,
    CAST(l_suppkey AS VARCHAR) || '.' || CAST(l_linenumber AS VARCHAR) AS b_dot,
    '-' || CAST(l_partkey AS VARCHAR) || '.9' AS c_neg,
    '+' || CAST(l_linenumber AS VARCHAR) AS d_plus,
    CAST(l_orderkey AS VARCHAR) || '000000000' AS e_big,
    CAST(l_orderkey AS VARCHAR) || '000000000.5' AS f_bigdot,
    CAST(l_linenumber AS VARCHAR) || 'e2' AS g_exp,
    CAST(l_linenumber AS VARCHAR) || '.0e2' AS h_dotexp,
    chr(9) || CAST(l_quantity AS VARCHAR) || chr(10) AS i_tabs,
    CASE l_returnflag WHEN 'N' THEN 'n/a' WHEN 'R' THEN '' ELSE '.' END AS j_junk
  FROM lineitem"""
ORACLE["clean_int"] = f"SELECT l_orderkey, l_linenumber, {_int_sel} FROM ({INT_CELLS_SQL})"
ORACLE["int_or_zero"] = f"SELECT l_orderkey, l_linenumber, {_zero_sel} FROM ({INT_CELLS_SQL})"

_dbl_cells = """SELECT p_partkey,
    CAST(p_size AS VARCHAR) || '.5' AS a_half, CAST(p_size AS VARCHAR) || '.49' AS b_under,
    '-' || CAST(p_size AS VARCHAR) || '.5' AS c_neg_half, CAST(p_size AS VARCHAR) || 'e1' AS d_exp,
    '  ' || CAST(p_size AS VARCHAR) || '.51 ' AS e_pad, 'x' || CAST(p_size AS VARCHAR) AS f_junk
  FROM part"""
ORACLE["clean_double_round"] = "SELECT p_partkey, " + ", ".join(
    f"try_cast(round_even({safe_double(c)}, 0) AS INTEGER) AS {c}" for c in DOUBLE_CELLS) + \
    f" FROM ({_dbl_cells})"


# --------------------------------------------------------------------------- G2 / G3
def _v(c: str) -> str:
    return f"CAST({c} AS VARCHAR)"


RECIPES_RAW = f"""SELECT l_orderkey, l_linenumber, l_shipdate,
  {_v('l_orderkey')} AS c_id, 'Recipe ' || {_v('l_orderkey')} AS c_name, {_v('l_suppkey')} AS c_author,
  'PT' || {_v('l_linenumber')} || 'M' AS c_cook, 'PT1H' AS c_total,
  'Line ' || {_v('l_linenumber')} || ' of ' || {_v('l_orderkey')} AS c_desc, l_returnflag AS c_cat,
  'c("' || l_returnflag || '", "' || l_linestatus || ', x")' AS c_kw,
  'c("part ' || {_v('l_partkey')} || '", "supp ' || {_v('l_suppkey')} || '")' AS c_ing,
  {_v('l_linenumber - 1')} || '.' || {_v('l_linenumber')} AS c_rating,
  {_v('l_quantity')} AS c_reviews,
  CASE WHEN l_linestatus = 'O' THEN '-' || {_v('l_partkey')} || '.5' ELSE {_v('l_partkey')} || '.5' END AS c_cal,
  {_v('l_linenumber')} AS c_nut, {_v('l_linenumber - 1')} AS c_serv, l_linestatus AS c_yield,
  'c("cut ' || {_v('l_partkey')} || '", "", "cook, ' || {_v('l_suppkey')} || ' min")' AS c_steps,
  'c("' || {_v('l_suppkey')} || '", "' || {_v('l_partkey')} || '")' AS c_fav
FROM lineitem"""

_NUTR = ["fat_content", "saturated_fat_content", "cholesterol_content", "sodium_content",
         "carbohydrate_content", "fiber_content", "sugar_content", "protein_content"]


def _half_even(c: str) -> str:
    return f"try_cast(round_even({safe_double(c)}, 0) AS INTEGER)"


RECIPES_TYPED = f"""SELECT l_orderkey, l_linenumber, c_kw, c_ing, c_steps,
  {safe_int('c_id')} AS recipe_id, {safe_str('c_name')} AS recipe_name, {safe_int('c_author')} AS author_id,
  {safe_str('c_cook')} AS cook_time, CAST(NULL AS VARCHAR) AS prep_time, {safe_str('c_total')} AS total_time,
  CAST(l_shipdate AS DATE) AS date_published, {safe_str('c_desc')} AS description,
  {safe_str('c_cat')} AS recipe_category,
  try_cast({safe_double('c_rating')} AS DECIMAL(3,1)) AS aggregated_rating,
  {_half_even('c_reviews')} AS review_count, {_half_even('c_cal')} AS calories,
  {", ".join(f"{_half_even('c_nut')} AS {c}" for c in _NUTR)},
  {_half_even('c_serv')} AS recipe_servings, {safe_str('c_yield')} AS recipe_yield,
  array_to_string({normalize_list('c_fav')}, '|') AS favorite_users
FROM ({RECIPES_RAW})"""

RECIPES_TAGGED = f"""SELECT *, CASE
  WHEN recipe_id IS NULL THEN 'bad_key:recipe_id'
  WHEN recipe_name IS NULL THEN 'not_null:recipe_name'
  WHEN aggregated_rating < 0 OR aggregated_rating > 5 THEN 'range:aggregated_rating'
  WHEN calories < 0 THEN 'range:calories'
  WHEN recipe_servings <= 0 THEN 'range:recipe_servings' END AS reason
FROM ({RECIPES_TYPED})"""

_RECIPE_COLS = ["recipe_id", "recipe_name", "author_id", "cook_time", "prep_time", "total_time",
                "date_published", "description", "recipe_category", "aggregated_rating",
                "review_count", "calories"] + _NUTR + ["recipe_servings", "recipe_yield",
                                                       "favorite_users"]
RECIPES_LOADED = f"""SELECT {", ".join(_RECIPE_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY recipe_id ORDER BY l_orderkey, l_linenumber,
      {", ".join(c + " ASC NULLS FIRST" for c in _RECIPE_COLS[1:])}) AS rn
  FROM ({RECIPES_TAGGED}) WHERE reason IS NULL) WHERE rn = 1"""
RECIPE_CHILD_SRC = (f"SELECT * FROM ({RECIPES_TYPED}) WHERE recipe_id IS NOT NULL "
                    f"AND recipe_id IN (SELECT recipe_id FROM ({RECIPES_LOADED}))")

ORACLE["import_recipes"] = RECIPES_LOADED
ORACLE["import_keywords"] = (f"SELECT recipe_id, unnest({parse_strs('c_kw')}) AS keyword_text "
                             f"FROM ({RECIPE_CHILD_SRC})")
ORACLE["import_ingredients"] = f"""SELECT recipe_id, unnest(list_filter(list_transform(
    {normalize_list('c_ing')}, lambda g: {jt(safe_str('g'))}), lambda g: g IS NOT NULL AND g <> ''))
    AS ingredient_text FROM ({RECIPE_CHILD_SRC})"""
ORACLE["import_instructions"] = f"""WITH a AS (SELECT recipe_id, list_filter(list_transform(
        {parse_strs('c_steps')}, lambda s: {jt('s')}), lambda s: s <> '') AS l FROM ({RECIPE_CHILD_SRC}))
    SELECT recipe_id, CAST(i AS INTEGER) AS step_order, l[i] AS instruction_text
    FROM (SELECT recipe_id, l, unnest(range(1, len(l) + 1)) AS i FROM a)"""
ORACLE["import_recipe_rejects"] = f"""SELECT 'recipes' AS "table", reason AS reject_reason, count(*) AS n
    FROM ({RECIPES_TAGGED}) WHERE reason IS NOT NULL GROUP BY 1, 2
    UNION ALL SELECT 'recipe_children', 'fk:recipe_id', n FROM (SELECT count(*) AS n FROM ({RECIPES_TYPED})
        WHERE recipe_id IS NOT NULL AND recipe_id NOT IN (SELECT recipe_id FROM ({RECIPES_LOADED}))) WHERE n > 0"""

REVIEWS_TYPED = f"""SELECT o_orderkey, {_v('o_custkey')} || ', ' || {_v('o_orderkey')} || ',x,,' || {_v('o_custkey')} AS c_likes,
  {safe_int(_v('o_custkey'))} AS review_id, {safe_int(_v('o_orderkey'))} AS recipe_id,
  {safe_int("CASE WHEN o_orderstatus = 'P' THEN '' ELSE " + _v('o_custkey') + " END")} AS author_id,
  {safe_int(_v("CAST(substr(o_orderpriority, 1, 1) AS INTEGER) + 2") + " || '.9'")} AS rating,
  {safe_str('o_orderstatus')} AS review_content,
  CAST(o_orderdate AS DATE) AS date_submitted, CAST(NULL AS DATE) AS date_modified
FROM orders"""
REVIEWS_TAGGED = f"""SELECT *, CASE WHEN review_id IS NULL THEN 'bad_key:review_id'
  WHEN author_id IS NULL THEN 'not_null:author_id'
  WHEN rating < 0 OR rating > 5 THEN 'range:rating' END AS reason FROM ({REVIEWS_TYPED})"""
ORACLE["import_reviews"] = f"""SELECT review_id, recipe_id, author_id, rating, review_content,
    date_submitted, date_modified FROM (SELECT *, row_number() OVER (PARTITION BY review_id
    ORDER BY o_orderkey) AS rn FROM ({REVIEWS_TAGGED}) WHERE reason IS NULL) WHERE rn = 1"""
ORACLE["import_likers"] = (f"SELECT review_id, unnest({parse_ids('c_likes')}) AS liker_id "
                           f"FROM ({REVIEWS_TYPED}) WHERE review_id IS NOT NULL")
ORACLE["import_review_rejects"] = f"""SELECT 'reviews' AS "table", reason AS reject_reason, count(*) AS n
    FROM ({REVIEWS_TAGGED}) WHERE reason IS NOT NULL GROUP BY 1, 2"""

ORACLE["import_metrics"] = f"""
    SELECT 'users' AS "table", 'read' AS stage, count(*) AS "rows" FROM lineitem
    UNION ALL SELECT 'users', unnest(['short_record', 'unterminated_quote', 'swallowed_records', 'escaped_quote',
        'cut:author_name', 'cut:gender']), 0
    UNION ALL SELECT 'users', 'rejected', count(*) FROM ({USERS_RAW})
        WHERE author_id IS NULL OR gender NOT IN ('Male', 'Female')
    UNION ALL SELECT 'users', 'valid', count(*) FROM ({USERS_RAW})
        WHERE author_id IS NOT NULL AND gender IN ('Male', 'Female')"""


# --------------------------------------------------------------------------- lines of text
# What the lines were made of, never a line taken apart.
_BLANK_IDS = f"CASE WHEN l_returnflag = 'N' THEN NULL ELSE {_v('l_suppkey')} || ',' || {_v('l_partkey')} END"
_LINE_KEY = f"CASE WHEN l_partkey % 7 = 0 THEN 'x' ELSE '' END || {_v('l_partkey')}"


def _line_cells(quote: str) -> str:
    return f"""SELECT l_orderkey, l_linenumber, {_LINE_KEY} AS author_id,
        'Ann {quote}the, ' || {_v('l_suppkey')} || '{quote}, Lee' AS author_name,
        CASE WHEN l_linestatus = 'O' THEN 'Male' ELSE 'Female' END AS gender, {_v('l_linenumber')} AS age,
        {_v('l_orderkey')} AS followers_count, {_v('l_suppkey')} AS following_count,
        {_BLANK_IDS} AS user_followers, {_BLANK_IDS} AS user_following FROM lineitem"""


ORACLE["feed_lines"] = ORACLE["feed_escaped"] = _line_cells('"')
ORACLE["feed_short"] = f"""SELECT {_LINE_KEY} AS key, 1 AS lines, 'short_record' AS reject_reason, count(*) AS n
    FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1"""
ORACLE["feed_unterminated"] = """SELECT CASE WHEN l_returnflag = 'A' THEN 'unterminated_quote' ELSE 'read' END AS reject_reason,
    count(*) AS n FROM lineitem GROUP BY 1"""
ORACLE["feed_import_rejects"] = f"""SELECT {_LINE_KEY} AS key, 'bad_key:author_id' AS reject_reason, count(*) AS n
    FROM lineitem WHERE l_partkey % 7 = 0 GROUP BY 1"""
ORACLE["feed_import_edges"] = """WITH u AS (SELECT DISTINCT CAST(l_partkey AS INTEGER) AS k FROM lineitem WHERE l_partkey % 7 <> 0),
    e AS (SELECT CAST(l_partkey AS INTEGER) AS user_id, CAST(unnest([l_suppkey, l_partkey]) AS INTEGER) AS follower_id
        FROM lineitem WHERE l_returnflag <> 'N' AND l_partkey % 7 <> 0)
    SELECT DISTINCT user_id, follower_id FROM e WHERE follower_id IN (SELECT k FROM u)"""
ORACLE["parse_ids_compat"] = "SELECT p_partkey, CAST(p_partkey AS INTEGER) AS id FROM part"
ORACLE["parse_strs_compat"] = """SELECT p_partkey, unnest(['c("' || p_brand || '"', '"' || p_type || ', ' || p_name || '")']) AS item
    FROM part"""
# The items that the cells were made of.
ORACLE["split_quoted_items"] = f"""WITH made AS (
    SELECT p_partkey, 'compat' AS mode, [{_v('p_partkey')}, '''it, ' || p_brand || '''', '"a,b ' || {_v('p_size')} || '"',
        'x\\"y', '''end, ' || p_name] AS items FROM part
    UNION ALL SELECT p_partkey, 'repaired', ['don''t ' || {_v('p_partkey')}, '"p, \\"q, ' || p_brand || '"',
        'z\\,w ' || {_v('p_size')}, '"end, ' || p_name] FROM part)
    SELECT p_partkey, mode, CAST(i - 1 AS INTEGER) AS pos, items[i] AS item
    FROM (SELECT *, unnest(range(1, len(items) + 1)) AS i FROM made)"""
ORACLE["cut_text"] = "SELECT doc_id, substr(text, 1, 255) AS text FROM documents"
ORACLE["surrogate_id"] = 'SELECT count(*) AS "rows", count(*) AS ids, 0 AS negative FROM lineitem'
ORACLE["timing_summary"] = """WITH m AS (SELECT event_type, avg(value) AS mean_ms, count(*) AS rounds FROM events GROUP BY 1)
    SELECT event_type, round(mean_ms, 6) AS mean_ms, rounds,
        round(mean_ms / (SELECT mean_ms FROM m WHERE event_type = 'click'), 6) AS ratio FROM m"""

# --------------------------------------------------------------------------- loads and stored tables
_CUT = f"TIMESTAMP '{LOAD_CUTOFF}'"
ORACLE["surrogate_id_loads"] = """SELECT count(*) AS "rows", count(*) AS ids, 0 AS "first", count(*) - 1 AS "last", 2 AS loads
    FROM lineitem WHERE l_shipdate IS NOT NULL"""
ORACLE["load_report"] = f"""SELECT 'users-00000000000' || CASE WHEN l_shipdate < {_CUT} THEN '1' ELSE '2' END AS load_id,
    'users' AS "table", 'loaded' AS stage, count(*) AS "rows" FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1"""
ORACLE["import_partition_metrics"] = ORACLE["import_metrics"]
ORACLE["keep_first_bucketed"] = f"""SELECT * FROM ({keep_first_sql(
    f"(SELECT * FROM lineitem WHERE l_shipdate >= {_CUT})", KEYS, LINE_REST, LINE_COLS)}) n WHERE NOT EXISTS
    (SELECT 1 FROM lineitem e WHERE e.l_shipdate < {_CUT} AND e.l_orderkey = n.l_orderkey AND e.l_linenumber = n.l_linenumber)"""
ORACLE["lookup_bucketed"] = """SELECT * FROM lineitem WHERE l_partkey =
    (SELECT p_partkey FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 1)"""
ORACLE["stored_update"] = f"""SELECT *, (SELECT count(*) FROM part WHERE p_size < 30) AS changed FROM ({ORACLE["update_where"]})"""
ORACLE["stored_delete"] = ORACLE["delete_where"]
ORACLE["stored_delete_in_limit"] = ORACLE["delete_in_limit"]
ORACLE["stored_cascade"] = f"""SELECT *, (SELECT count(*) FROM orders WHERE o_orderpriority = '1-URGENT') AS orders_deleted
    FROM ({ORACLE["cascade_delete"]})"""
ORACLE["feed_marks"] = """SELECT CAST(l_partkey AS VARCHAR) AS author_id,
    'Ann ' || chr(57344) || ' ' || chr(57345) || ' ' || chr(57345) || '0 ' || chr(92) || ' Lee ' || CAST(l_suppkey AS VARCHAR) AS author_name,
    'Male' AS gender, l_orderkey, l_linenumber FROM lineitem"""
ORACLE["feed_multi_line"] = """SELECT CAST(l_partkey AS VARCHAR) AS author_id,
    'Ann "the' || chr(10) || chr(10) || CAST(l_suppkey AS VARCHAR) || '"' || chr(10) || 'Lee, ' AS author_name, 'Male' AS gender,
    CAST(l_linenumber AS VARCHAR) AS age, CAST(l_orderkey AS VARCHAR) AS followers_count FROM lineitem"""
