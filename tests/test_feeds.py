import csv
import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from feedworks.operators import sinks
from feedworks.plans import imports, suites
from feedworks.plans.load import load
from feedworks.schemas import RECIPES_COLUMNS, REVIEWS_COLUMNS, USERS_COLUMNS
from feedworks.sources import from_rows, read_feed
from feedworks.sources.csv_feed import read_records, split_lines


def _key(row):
    return tuple((v is not None, v) for v in row)


def rows(df, *cols):
    src = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in src.collect()), key=_key)


USERS_CSV = (
    "author_id,name,gender,age,followers,following,fol,ing\n"
    '1,Alice,Female,30,10,5,"2, 3","2,3"\n'
    '1,Alice2,Female,31,11,6,"3",\n'
    "2, Bob ,Male,25,3,1,1,1\n"
    "3,Carol,F,40,7,7,,\n"
    "4,Dan,,121,1,1,,\n"
    "x5,Eve,Female,20,1,1,,\n"
    "6,Frank,Male\n"
    "7,Gina,Female,22,200,1,7,7,extra,cols\n"
    '8,"Hal\nJones",Male,33,0,0,"1,99",\n'
    '9,"Ivy ""The"" Best",female,44,150,0,,\n'
    "12.0,Jo,Male,51,0,0,,\n"
    "12,Jo2,Male,52,0,0,,\n"
)


@pytest.fixture(scope="module")
def feed_dir():
    d = tempfile.mkdtemp(prefix="feedworks-test-")
    with open(os.path.join(d, "users.csv"), "w") as f:
        f.write(USERS_CSV)
    with open(os.path.join(d, "empty.csv"), "w") as f:
        f.write("")
    with open(os.path.join(d, "header_only.csv"), "w") as f:
        f.write("a,b,c,d,e,f,g,h\n")
    rec = []
    base = {c: "" for c in RECIPES_COLUMNS}
    r1 = dict(base, recipe_id="10", recipe_name="Cake", author_id="1", cook_time="PT1H",
              date_published="1999-08-09T21:46:00Z", description="nice", recipe_category="Dessert",
              keywords='c("Dessert", "Low, fat")', recipe_ingredient='c("flour", "sugar ", "")',
              aggregated_rating="4.25", review_count="3.0", calories="170.9", fat_content="2.5",
              recipe_servings="2", recipe_yield="1 cake",
              recipe_instructions='c("mix", "", "bake, then cool")', favorite_users='c("u1", "u2")')
    rec.append(r1)
    rec.append(dict(base, recipe_id="11", recipe_name="Bad", aggregated_rating="123.4"))
    rec.append(dict(base, recipe_id="12", recipe_name="Neg", calories="-5"))
    rec.append(dict(base, recipe_id="13", recipe_name="Orphan", author_id="999"))
    rec.append(dict(r1, recipe_name="Cake again", keywords="Extra"))
    rec.append(dict(base, recipe_id="14", recipe_name="NULL"))
    with open(os.path.join(d, "recipes.csv"), "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(RECIPES_COLUMNS)
        for r in rec:
            w.writerow([r[c] for c in RECIPES_COLUMNS])
    rev = [["1", "10", "1", "A", "4.9", "good", "2020-01-02T03:04:05Z", "2020-01-03", "1, 2,x,,2"],
           ["2", "10", "", "B", "3", "meh", "", "", ""],
           ["3", "10", "2", "C", "7", "wow", "", "", "NULL"],
           ["1", "11", "3", "D", "1", "dup", "", "", "5"]]
    with open(os.path.join(d, "reviews.csv"), "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(REVIEWS_COLUMNS)
        w.writerows(rev)
    return d


def test_read_feed_arity_and_quotes(spark, feed_dir):
    feed = read_feed(spark, os.path.join(feed_dir, "users.csv"), USERS_COLUMNS, multi_line=True)
    recs = {r.author_id: r for r in feed.records.collect()}
    assert "6" not in recs and len(recs) == 10        # short row rejected, duplicates kept
    assert recs["8"].author_name == "Hal\nJones"
    assert recs["9"].author_name == 'Ivy "The" Best'
    assert recs["7"].user_following == "7"             # long row keeps the first 8 fields
    assert rows(feed.rejects, "key", "reject_reason") == [("6", "short_record")]


def test_read_feed_empty_inputs(spark, feed_dir):
    for name in ("empty.csv", "header_only.csv"):
        feed = read_feed(spark, os.path.join(feed_dir, name), USERS_COLUMNS)
        assert feed.records.count() == 0 and feed.rejects.count() == 0


def test_import_users(spark, feed_dir):
    out = imports.import_users(spark, os.path.join(feed_dir, "users.csv"), multi_line=True)
    users = rows(out["users"], "author_id", "author_name", "gender", "age")
    assert users == [(1, "Alice", "Female", 30), (2, "Bob", "Male", 25), (7, "Gina", "Female", 22),
                     (8, "Hal\nJones", "Male", 33), (12, "Jo", "Male", 51)]
    assert rows(out["user_followers"], "user_id", "follower_id") == [(1, 2), (2, 1), (7, 7), (8, 1)]
    assert rows(out["user_following"], "user_id", "following_id") == [(1, 2), (2, 1)]
    reasons = rows(out["rejects"].groupBy("table", "reject_reason").count())
    assert ("users", "in_set:gender", 2) in reasons     # F and female are not in the set
    assert ("users", "range:age", 1) in reasons
    assert ("users", "bad_key:author_id", 1) in reasons
    assert ("users", "short_record", 1) in reasons
    assert ("user_followers", "fk:follower_id", 3) in reasons
    assert out["users"].schema["author_id"].dataType.simpleString() == "int"


def test_import_recipes(spark, feed_dir):
    users = imports.import_users(spark, os.path.join(feed_dir, "users.csv"), multi_line=True)["users"]
    out = imports.import_recipes(spark, os.path.join(feed_dir, "recipes.csv"), users=users)
    r = out["recipes"].collect()
    assert [x.recipe_id for x in r] == [10]
    cake = r[0]
    assert cake.recipe_name == "Cake" and cake.aggregated_rating == Decimal("4.3")
    assert cake.calories == 171 and cake.fat_content == 2 and cake.review_count == 3
    assert cake.date_published == dt.date(1999, 8, 9)
    assert cake.favorite_users == ["u1", "u2"]
    assert rows(out["keywords"], "recipe_id", "keyword_text") == \
        [(10, "Dessert"), (10, "Extra"), (10, "Low, fat")]
    assert rows(out["recipe_ingredients"], "ingredient_text") == \
        [("flour",), ("flour",), ("sugar",), ("sugar",)]
    steps = rows(out["recipe_instructions"], "step_order", "instruction_text")
    assert steps == [(1, "mix"), (1, "mix"), (2, "bake, then cool"), (2, "bake, then cool")]
    reasons = dict(((k, v), n) for k, v, n in out["rejects"].groupBy("key", "reject_reason").count().collect())
    assert reasons[("11", "fits:aggregated_rating")] == 1
    assert reasons[("12", "range:calories")] == 1
    assert reasons[("13", "fk:author_id")] == 1
    assert reasons[("14", "not_null:recipe_name")] == 1
    # records without a loaded recipe leave a reject for their children
    assert all(reasons[(k, "fk:recipe_id")] == 1 for k in ("11", "12", "13", "14"))


def test_import_reviews(spark, feed_dir):
    out = imports.import_reviews(spark, os.path.join(feed_dir, "reviews.csv"))
    assert rows(out["reviews"], "review_id", "rating", "date_submitted", "date_modified") == \
        [(1, 4, dt.date(2020, 1, 2), None)]
    assert rows(out["review_likers"], "review_id", "liker_id") == [(1, 1), (1, 2), (1, 2), (1, 5)]
    assert rows(out["rejects"], "key", "reject_reason") == [("2", "not_null:author_id"),
                                                            ("3", "range:rating")]


def test_file_suite_on_csv(spark, feed_dir):
    users = suites.file_users(spark, os.path.join(feed_dir, "users.csv"))
    out = suites.file_suite(users)
    s = out["summary"].first().asDict()
    # line-oriented reader: the quoted newline splits record 8 into two short lines
    assert s["remaining_users"] == users.filter(F.col("age") <= 50).count()
    assert s["updated"] == users.filter(F.col("age") < 30).count()
    assert s["female"] == 6          # every line counts: no keep-first in this suite
    bands = dict(rows(out["age_bands"]))
    assert set(bands) <= {0, 20, 30, 40, 50}


def test_file_suite_reads_writes_and_reports(spark, feed_dir):
    d = tempfile.mkdtemp(prefix="feedworks-suite-")
    out = suites.run_file_suite(spark, os.path.join(feed_dir, "users.csv"), d, rounds=2)
    users = suites.file_users(spark, os.path.join(feed_dir, "users.csv"))
    read = lambda name: spark.read.option("header", True).option("escape", '"').csv(f"{d}/{name}")
    assert read("output_all").count() == read("output_updated").count() == users.count()
    assert read("output_deleted").count() == users.filter(F.col("age") <= 50).count()
    ups = dict(rows(read("output_updated").where("age < 30 AND author_id = '2'"), "author_id", "followers_count"))
    assert ups == {"2": "4"}
    assert read("timings").count() == 2 * 9 and read("means").count() == 9
    assert [r.run for r in out["runs"].orderBy("run").collect()] == [1, 2]
    assert {r.age_group for r in read("age_bands").collect()} >= {"20-29", "30-39"}


def test_db_suite_on_import(spark, feed_dir):
    out = imports.import_users(spark, os.path.join(feed_dir, "users.csv"), multi_line=True)
    suite = suites.db_suite(out["users"], out["user_followers"],
                            p=suites.SuiteParams(group_min_count=0, delete_age_above=50))
    c = suite["counts"].first()
    assert (c.total, c.age_in_range, c.followers_over, c.gender_match) == (5, 3, 1, 2)
    assert suite["updated"].first()[0] == 2
    assert suite["deleted"].first()[0] == 1
    assert rows(suite["users_after"], "author_id", "followers_count") == \
        [(1, 10), (2, 4), (7, 201), (8, 0)]
    joined = rows(suite["joined"])
    assert ("Female", 2, 105.5) in joined


def test_sinks_roundtrip(spark, feed_dir):
    out = imports.import_users(spark, os.path.join(feed_dir, "users.csv"), multi_line=True)
    d = tempfile.mkdtemp(prefix="feedworks-sink-")
    sinks.write_csv(out["users"], d + "/users_csv")
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"') \
        .csv(d + "/users_csv")
    assert rows(back, "author_name") == rows(out["users"], "author_name")
    sinks.write_sorted(out["users"], d + "/users_sorted", "author_id", partitions=2)
    assert spark.read.parquet(d + "/users_sorted").count() == 5
    sinks.write_parquet(out["user_followers"], d + "/edges")
    assert spark.read.parquet(d + "/edges").count() == 4


BROKEN = ('h1,h2,h3,h4,h5,h6,h7,h8\n1,Al,Male,30,1,1,,\n2,"Bo,Male,30,1,1,,\n3,Cy,Male,30,1,1,,\n'
          '4,Di,Female,30,1,1,"1,3",\n5,Ed,Male,30,1,1,,\n')
ESCAPED = ('h1,h2,h3,h4,h5,h6,h7,h8\n1,"Al \\"x, y\\" B",Male,30,1,1,,\n2,Bo,Male,30,1,1,,\n'
           '3,"back\\\\",Male,30,1,1,1,2\n')


def feed_file(text):
    path = os.path.join(tempfile.mkdtemp(prefix="feedworks-test-"), "feed.csv")
    with open(path, "w") as f:
        f.write(text)
    return path


def test_unclosed_quote_costs_its_own_line_only(spark):
    out = imports.import_users(spark, feed_file(BROKEN))
    assert rows(out["users"], "author_id") == [(1,), (3,), (4,), (5,)]
    assert rows(out["rejects"], "key", "reject_reason", "record", "lines") == \
        [("2", "unterminated_quote", '2,"Bo,Male,30,1,1,,', 1)]
    assert rows(out["user_followers"], "user_id", "follower_id") == [(4, 1), (4, 3)]
    counts = {r.stage: r.rows for r in out["metrics"].collect()}
    assert counts["read"] + counts["unterminated_quote"] == 5 and counts["valid"] == 4


def test_unclosed_quote_with_newlines_allowed_keeps_what_it_swallowed(spark):
    out = imports.import_users(spark, feed_file(BROKEN.replace('"1,3"', "")), multi_line=True)
    assert rows(out["users"], "author_id") == [(1,)]
    (bad,) = out["rejects"].collect()
    assert bad.reject_reason == "unterminated_quote" and bad.lines >= 4 and "5,Ed" in bad.record
    # a quote that meets the next one of the file: whole records in one cell
    out = imports.import_users(spark, feed_file(BROKEN), multi_line=True)
    reasons = {r.reject_reason: r for r in out["rejects"].where("table = 'users'").collect()}
    assert "3,Cy" in "".join(r.record or "" for r in reasons.values())
    total = out["users"].count() + sum(r.lines for r in reasons.values())
    assert total == 5 and set(reasons) <= {"swallowed_records", "unterminated_quote", "short_record"}


def test_backslash_escaped_quotes(spark):
    out = imports.import_users(spark, feed_file(ESCAPED))
    assert rows(out["users"], "author_id", "author_name") == [(1, 'Al "x, y" B'), (2, "Bo"), (3, "back\\")]
    assert out["rejects"].count() == 0
    assert rows(out["user_followers"], "user_id", "follower_id") == [(3, 1)]
    out = imports.import_users(spark, feed_file(ESCAPED), multi_line=True)
    assert rows(out["rejects"], "key", "reject_reason")[0] == ("1", "escaped_quote")
    assert (1, 1) not in rows(out["tagged_edges"], "user_id", "other")


def test_every_line_is_read_or_rejected(spark):
    text = "h\n" + "".join(f"{i}{c}\n" for i, c in enumerate(
        (",a,Male,1,1,1,,", ',"a', ",a", "", ',"a ""b"" c",Male,1,1,1,,', ",a\x01b,Male,1,1,1,,,", ',"a\\"",Male,1,1,1,,', '"',)))
    feed = read_feed(spark, feed_file(text), USERS_COLUMNS)
    assert feed.records.count() + feed.rejects.count() == 8
    assert {r.reject_reason for r in feed.rejects.collect()} == {"short_record", "unterminated_quote"}


def test_metrics_need_one_scan_and_no_join(spark, capsys):
    out = imports.import_users(spark, feed_file(BROKEN), persist=False)
    out["metrics"].explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan csv") == 1 and "Join" not in plan


def test_cut_cells_are_counted_and_length_is_a_choice(spark):
    path = feed_file("h1,h2,h3,h4,h5,h6,h7,h8\n1," + "n" * 80 + ",Male,30,1,1,,\n2,Bo,Male,30,1,1,,\n")
    out = imports.import_users(spark, path, max_len=50)
    assert {r.stage: r.rows for r in out["metrics"].collect()}["cut:author_name"] == 1
    assert max(len(r.author_name) for r in out["users"].collect()) == 50
    whole = imports.import_users(spark, path, max_len=None)["users"]
    assert max(len(r.author_name) for r in whole.collect()) == 80


def test_load_twice_adds_nothing(spark, feed_dir):
    target = tempfile.mkdtemp(prefix="feedworks-load-")
    feeds = {n: os.path.join(feed_dir, f"{n}.csv") for n in ("users", "recipes", "reviews")}
    first = {(r.table, r.stage): r.rows for r in load(spark, feeds, target, reset=True, multi_line=True).collect()}
    tables = ("users", "user_followers", "user_following", "recipes", "keywords", "recipe_ingredients",
              "recipe_instructions", "reviews", "review_likers")
    held = {t: spark.read.parquet(f"{target}/{t}").count() for t in tables}
    assert held == {t: first[t, "loaded"] for t in tables} and held["users"] == 5 and held["keywords"] == 3
    again = {(r.table, r.stage): r.rows for r in load(spark, feeds, target, multi_line=True).collect()}
    assert all(again[t, "loaded"] == 0 for t in tables)
    assert {t: spark.read.parquet(f"{target}/{t}").count() for t in tables} == held
    assert spark.read.parquet(f"{target}/report").count() == len(again)
    # a reset starts anew
    load(spark, feeds, target, reset=True, multi_line=True)
    assert {t: spark.read.parquet(f"{target}/{t}").count() for t in tables} == held


def test_import_with_checkpoint(spark, feed_dir):
    out = imports.import_users(spark, os.path.join(feed_dir, "users.csv"), multi_line=True, persist="checkpoint")
    assert out["users"].count() == 5 and out["user_followers"].count() == 4


# ------------------------------------------------------------------ work done once for a row
def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_filters_on_read_and_rule_reasons_compute_nothing_again(spark):
    lines = spark.createDataFrame([('1,"Ann ""A""",Male,3,1,1,"2,3","4"', 1), ("2,short", 2)], "_line string, _ingest_order int")
    feed = split_lines(lines, USERS_COLUMNS)
    for df in (feed.records, feed.rejects):
        assert _optimized(df).count("regexp_replace(") <= 2  # the length of a line without its quotes, and without commas
    out = imports.import_users(spark, feed)
    assert _optimized(out["users"]).count("from_csv(") == 1
    assert [r["author_id"] for r in out["users"].collect()] == [1]
    assert [(r["key"], r["reject_reason"]) for r in out["rejects"].where("table = 'users'").collect()] == [("2", "short_record")]


def test_records_with_newlines_are_cut_once(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text('h\n1,"Ann\n\nLee",Male,3,1,1,,\n2,x\n')
    feed = read_records(spark, str(path), USERS_COLUMNS, ingest_order=False)
    assert _optimized(feed.records).count("from_csv(") == 1
    assert [(r["author_id"], r["author_name"]) for r in feed.records.collect()] == [("1", "Ann\n\nLee")]
    assert [(r["key"], r["reject_reason"]) for r in feed.rejects.collect()] == [("2", "short_record")]


def test_one_output_alone_keeps_no_copy_of_the_feed(spark):
    rows = spark.createDataFrame([("1", "Ann", "Male", "3", "1", "1", "1", "1")], USERS_COLUMNS)
    out = imports.import_users(spark, from_rows(rows, USERS_COLUMNS))
    assert out["users"].count() == 1 and not out["cleaned"].is_cached
    imports.keep(out)
    assert out["cleaned"].is_cached and "InMemoryRelation" in out["users"].select("*")._jdf.queryExecution().withCachedData().toString()
    imports.release(out)
