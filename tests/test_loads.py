"""Loads that break off, ids over loads and batches, stored tables, and layouts that keep the target still."""

import os
import tempfile
import uuid
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedworks import streaming
from feedworks.operators import flatten, ledger, metrics, sinks, stored, upsert
from feedworks.plans.load import load
from feedworks.schemas import TARGETS, USERS_COLUMNS
from feedworks.session import shared_path, staged
from feedworks.sources import splits
from feedworks.sources.csv_feed import read_feed, read_records

HEAD = "h1,h2,h3,h4,h5,h6,h7,h8\n"
USERS = [HEAD + '1,Al,Male,30,1,1,"2,3",2\n2,Bo,Male,30,1,1,1,\n3,Cy,Female,40,1,1,,1\n',
         HEAD + '3,Again,Male,30,1,1,1,\n4,Di,Female,30,1,1,"1,2,3",1\n']
REVIEWS = "a,b,c,d,e,f,g,h,i\n" + "10,1,1,x,5,fine,,,\"1,2,2\"\n11,1,2,x,4,good,,,3\n"


def file_of(text, name="feed.csv"):
    path = os.path.join(tempfile.mkdtemp(prefix="feedworks-test-"), name)
    with open(path, "w") as f:
        f.write(text)
    return path


def seen(spark, target, table, *columns):
    rows = ledger.committed(spark, target, table, TARGETS[table])
    return sorted(tuple(r) for r in rows.select(*columns).collect()) if rows is not None else []


def ids(spark, target, table):
    return sorted(r[0] for r in ledger.committed(spark, target, table, TARGETS[table]).select(TARGETS[table].names[0]).collect())


# ---------------------------------------------------------------- loads
def test_a_load_that_breaks_off_anywhere_can_be_run_again(spark, monkeypatch):
    """Stopped before each of its writes in turn, and before its commit record: readers see
    nothing of it, and the run that comes through has each row once."""
    target = shared_path(spark, "crash")
    feeds = {"reviews": file_of(REVIEWS)}
    write = ledger.write
    for stop in range(5):  # partition counts, likers, reviews, rejects, commit record
        calls = Counter()

        def breaks(*args, **kwargs):
            calls["n"] += 1
            if calls["n"] > stop:
                raise RuntimeError("executor lost")
            return write(*args, **kwargs)

        def no_commit(*args):
            raise RuntimeError("driver lost")

        with monkeypatch.context() as m:
            m.setattr(ledger, "write", breaks)
            if stop == 4:
                m.setattr(ledger, "write", write)
                m.setattr(ledger, "commit", no_commit)
            with pytest.raises(RuntimeError, match="lost"):
                load(spark, feeds, target)
        assert seen(spark, target, "reviews", "review_id") == []
        assert seen(spark, target, "review_likers", "review_id") == []
    load(spark, feeds, target)
    assert seen(spark, target, "reviews", "review_id") == [(10,), (11,)]
    assert seen(spark, target, "review_likers", "review_id", "liker_id") == [(10, 1), (10, 2), (10, 2), (11, 3)]
    assert spark.read.parquet(f"{target}/review_likers").count() == 4  # nothing left of what broke off
    counts = {(r.table, r.stage): r.rows for r in ledger.report(spark, target).collect()}
    assert counts["reviews", "read"] == 2 and counts["review_likers", "loaded"] == 4
    load(spark, feeds, target)
    assert len(seen(spark, target, "review_likers", "review_id")) == 4


def test_ids_go_on_over_loads_and_batches(spark):
    """Two batch loads and two stream batches into one target: every id once, none given twice."""
    target = shared_path(spark, "ids")
    for text in USERS:
        load(spark, {"users": file_of(text)}, target)
    assert seen(spark, target, "user_followers", "user_id", "follower_id") == [(1, 2), (1, 3), (2, 1), (3, 1), (4, 1), (4, 2), (4, 3)]
    assert ids(spark, target, "user_followers") == list(range(7))
    cells = lambda k, others: [str(k), f"U{k}", "Male", "20", "1", "1", others, ""]
    schema = ", ".join(f"{c} string" for c in USERS_COLUMNS) + ", _corrupt_record string, _file string, _block long"
    for n, (k, others) in enumerate(((5, "1,2"), (6, "5,1"), (6, "5,1"))):
        batch = spark.createDataFrame([(*cells(k, others), None, "f", 0)], schema)
        done = streaming.load_batch(spark, batch, min(n, 1), "users", target, source="checkpoint")
        assert done is (n < 2)  # the third is the second one replayed
    assert ids(spark, target, "user_followers") == list(range(11))
    report = ledger.report(spark, target).where("table = 'users' AND stage = 'read'")
    assert sorted((r.load_id, r.batch, r.rows) for r in report.collect()) == [
        ("users-000000000001", None, 3), ("users-000000000002", None, 2), ("users-000000000003", 0, 1), ("users-000000000004", 1, 1)]


def test_repeated_tasks_and_other_splits_give_the_same_ids(spark):
    rows, path = staged(spark.range(5000).repartition(7).toDF("v"), "test")
    first = flatten.with_ids(rows, "id", 100)
    want = {r.v: r.id for r in first.collect()}
    assert sorted(want.values()) == list(range(100, 5100))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        again = flatten.with_ids(spark.read.parquet(path), "id", 100)
        assert again.rdd.getNumPartitions() != first.rdd.getNumPartitions()
        assert {r.v: r.id for r in again.collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_stored_table_that_does_not_fit_names_its_column(spark):
    for change, message in ((lambda d: d.withColumn("rating", F.col("rating").cast("string")), "rating is stored as string"),
                            (lambda d: d.drop("author_id"), "author_id is missing"),
                            (lambda d: d.withColumn("more", F.lit(1)), "more is not a column")):
        target = shared_path(spark, "fit")
        change(sinks.empty_table(spark, TARGETS["reviews"])).write.parquet(f"{target}/reviews/load_id=reviews-000000000001")
        with pytest.raises(ValueError, match=message):
            load(spark, {"reviews": file_of(REVIEWS)}, target)
        assert ledger.commits(spark, target).count() == 0


def test_shared_folder_must_be_named():
    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_path(Session, "x")


def test_counts_by_partition_add_up_in_one_pass(spark, capsys):
    df = spark.range(0, 1000, 1, 5)
    stages = {"all": F.lit(True), "odd": F.col("id") % 2 == 1}
    parts = metrics.stage_counts(df, "t", stages, by_partition=True)
    assert sorted((r.partition, r.stage, r.rows) for r in parts.collect()) == [
        (p, s, n) for p in range(5) for s, n in (("all", 200), ("odd", 100))]
    assert {(r.table, r.stage, r.rows) for r in metrics.totals(parts).collect()} == {("t", "all", 1000), ("t", "odd", 500)}


# ---------------------------------------------------------------- stored tables
def files(path):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(path) for n in names
            if n.startswith("part-")}


def ranged(spark, n=100, width=10):
    path = shared_path(spark, "stored").removeprefix("file:")
    stored.write_ranged(spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 7).cast("int").alias("v")), path, "k", width)
    return path


def test_update_leaves_other_partitions_as_they_are(spark):
    path = ranged(spark)
    before = files(path)
    assert stored.update(spark, path, "v", F.col("v") + 100, F.col("k").between(20, 33)) == 14
    after = files(path)
    same = {f for f in before if after.get(f) == before[f]}
    assert same == {f for f in before if "key_range=2/" not in f and "key_range=3/" not in f}
    assert {r.k: r.v for r in stored.read_ranged(spark, path).collect()} == {k: k % 7 + 100 * (20 <= k <= 33) for k in range(100)}
    assert stored.read_ranged(spark, path).schema["v"].dataType.simpleString() == "int"
    assert stored.update(spark, path, "v", 1, F.col("k") > 1000) == 0 and files(path) == after


def test_delete_rewrites_and_empties_partitions(spark):
    path = ranged(spark)
    before = files(path)
    assert stored.delete(spark, path, F.col("k").between(15, 39) | (F.col("k") == 92)) == 26  # 20s and 30s go whole
    left = sorted(r.k for r in stored.read_ranged(spark, path).collect())
    assert left == [k for k in range(100) if not (15 <= k <= 39 or k == 92)]
    untouched = [f for f in before if not any(f"key_range={r}/" in f for r in (1, 2, 3, 9))]
    assert untouched and all(files(path).get(f) == before[f] for f in untouched)
    assert stored.delete(spark, path, F.col("k") < 0) == 0
    assert stored.delete(spark, path, F.lit(True)) == 74 and stored.read_ranged(spark, path).count() == 0


def test_delete_by_keys_and_cascade(spark):
    path, child = ranged(spark), ranged(spark, 300, 50)
    before = files(path)
    assert stored.delete_in_limit(spark, path, "k", 10, F.col("v") == 3, 4) == 4  # 3, 10, 17, 24
    assert sorted(set(range(100)) - {r.k for r in stored.read_ranged(spark, path).collect()}) == [3, 10, 17, 24]
    assert all(files(path).get(f) == before[f] for f in before if not any(f"key_range={r}/" in f for r in (0, 1, 2)))
    doomed = spark.createDataFrame([(5,), (5,), (250,), (None,), (10**12,)], "k long")
    assert stored.cascade_delete(spark, path, "k", 10, doomed, [(child, "k", 50)]) == {child: 2, path: 1}
    assert stored.read_ranged(spark, child).where("k IN (5, 250)").count() == 0 and stored.read_ranged(spark, child).count() == 298


def test_ranges_of_odd_keys(spark):
    df = spark.createDataFrame([(None,), (-1,), (-10,), (2**62 + 1,), (0,)], "k long")
    path = shared_path(spark, "odd")
    stored.write_ranged(df, path, "k", 10)
    got = {r.k: r.key_range for r in spark.read.parquet(path).collect()}
    assert got == {None: None, -1: -1, -10: -1, 2**62 + 1: (2**62 + 1) // 10, 0: 0}
    assert stored.delete(spark, path, F.col("k").isNull()) == 1 and stored.read_ranged(spark, path).count() == 4


# ---------------------------------------------------------------- layouts
def plan_of(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_membership_in_a_bucketed_target_does_not_move_it(spark, capsys, no_broadcast):
    name = f"keys_{uuid.uuid4().hex}"
    upsert.write_index(spark.range(3000).toDF("k"), name, "k", 8, path=shared_path(spark, "keys"))
    upsert.write_index(spark.range(3000, 3500).toDF("k"), name, "k", 8)  # a later load
    new = spark.range(2900, 4000).toDF("k").withColumn("v", F.lit(1))
    out = upsert.new_rows(new, spark.table(name), "k")
    plan = plan_of(out, capsys)
    target = plan[plan.index("FileScan parquet"):]
    assert "Bucketed: true" in target and "Exchange" not in target
    between = plan[:plan.index("FileScan parquet")].splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    scan = depth(plan[:plan.index("FileScan parquet")].splitlines()[-1])
    join = max(i for i, line in enumerate(between) if "Join" in line)
    branch = [line for line in between[join + 1:] if depth(line) < scan and ":" not in line]
    assert not any("Exchange" in line for line in branch)
    assert sorted(r.k for r in out.collect()) == list(range(3500, 4000))
    spark.sql(f"DROP TABLE {name}")


def test_lookup_reads_the_buckets_of_its_keys(spark):
    name, path = f"lookup_{uuid.uuid4().hex}", shared_path(spark, "lookup")
    sinks.write_bucketed(spark.range(4000).toDF("k"), name, "k", 16, path=path)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    assert len(files(path.removeprefix("file:"))) == 16
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1g")  # a task for each file
        out = sinks.lookup(table, "k", [123])
        assert table.rdd.getNumPartitions() == 16 and out.rdd.getNumPartitions() == 1
        assert sinks.lookup(table, "k", list(range(40))).rdd.getNumPartitions() > 1
        assert [r.k for r in out.collect()] == [123]
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)


# ---------------------------------------------------------------- newlines in cells, read by many tasks
NASTY = (HEAD + '1,"Al\nice",Male,30,1,1,"2,3",2\n\n2,Bo,Male,30,1,1,1,\n3,"Cy ""the\n\n, 7,x"" Q\n",Female,40,1,1,,1\n'
         + "4,short,Male\n5,Ed,Male,30,1,1,,,more,fields\n" + "".join(f'{k},"many\nlines {k}\nof text",Male,30,1,1,,\n' for k in range(100, 160))
         + '6,"back\\"slash",Male,30,1,1,,\n60,stray" quotes "in" text,Male,30,1,1,,\n61,"C:\\",Male,30,1,1,,\n62,"end",Male,30,1,1,"1,\n2" x"y,3\n')


@pytest.mark.parametrize("text", [NASTY, NASTY + '7,"never closed,Male,1,1,1,,\n8,Fay,Male,30,1,1,,\n', HEAD, HEAD.replace("h2", '"h\n2"') + "1,Al,Male,30,1,1,,\n",
                                  NASTY.replace("\n", "\r\n")], ids=["mixed", "unclosed", "header", "split header", "crlf"])
def test_records_of_split_files_are_those_of_the_one_task_reader(spark, text):
    path = file_of(text)
    want = read_feed(spark, path, USERS_COLUMNS, multi_line=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "170")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = read_feed(spark, path, USERS_COLUMNS, multi_line="split")
        if len(text) > 1000:
            assert spark.read.text(path).rdd.getNumPartitions() > 5
        rows = lambda df, columns: sorted(tuple(str(x) for x in r) for r in df.select(*columns).collect())
        assert rows(got.records, USERS_COLUMNS) == rows(want.records, USERS_COLUMNS)
        assert rows(got.rejects, ["key", "reject_reason", "lines"]) == rows(want.rejects, ["key", "reject_reason", "lines"])
        order = [r[0] for r in got.records.orderBy("_ingest_order").select("author_id").collect()]
        assert order == [r[0] for r in want.records.orderBy("_ingest_order").select("author_id").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_a_quote_that_is_never_closed_does_not_gather_the_file(spark):
    path = file_of(HEAD + '1,Al,Male,30,1,1,,\n2,"Bo,Male,30,1,1,,\n' + "".join(f"{k},x,Male,1,1,1,,\n" for k in range(10, 200)))
    feed = read_records(spark, path, USERS_COLUMNS, max_lines=20)
    assert [r.author_id for r in feed.records.collect()] == ["1"]
    assert [(r.key, r.record, r.lines, r.reject_reason) for r in feed.rejects.collect()] == [
        ("2", '2,"Bo,Male,30,1,1,,', 191, "unterminated_quote")]


def shuffled_rows(df):
    """Rows that the exchanges of ``df`` have written; it is run for it."""
    df.collect()

    def of(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return of(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return of(node.plan())
        written = node.metrics().get("shuffleRecordsWritten")
        children = node.children()
        return (written.get().value() if written.isDefined() else 0) + sum(of(children.apply(i)) for i in range(children.length()))
    return of(df._jdf.queryExecution().executedPlan())


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes",
                                             "spark.sql.execution.arrow.maxRecordsPerBatch")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield lambda size, batch=10_000: (spark.conf.set("spark.sql.files.maxPartitionBytes", str(size)),
                                      spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch)))
    for k, v in before.items():
        spark.conf.set(k, v)


def test_lines_of_a_split_stay_with_the_task_that_reads_them(spark, small_splits):
    """A task's memory does not grow with the lines of a split: none is sorted or held for a window."""
    path = file_of(HEAD + "".join(f'{k},"Ann ""the\n\n{k}""\nLee, ",Male,1,{k},1,,\n' for k in range(1500)))
    small_splits(8000)
    records = read_records(spark, path, USERS_COLUMNS).records
    assert spark.read.text(path).rdd.getNumPartitions() > 3
    assert shuffled_rows(records) < 100  # of 6,001 lines
    assert sorted((int(r.author_id), r.author_name, r.followers_count) for r in records.collect()) == [
        (k, f'Ann "the\n\n{k}"\nLee, ', str(k)) for k in range(1500)]


@pytest.mark.parametrize("size,batch,room", [(60, 2, 0), (170, 3, 40), (400, 1, 10)])
def test_pieces_without_room_are_read_again(spark, small_splits, size, batch, room):
    path = file_of(NASTY + '7,"' + "long\n" * 200 + 'end",Male,1,1,1,,\n8,Fay,Male,30,1,1,,\n')
    want = read_feed(spark, path, USERS_COLUMNS, multi_line=True)
    small_splits(size, batch)
    got = read_records(spark, path, USERS_COLUMNS, room=room)
    rows = lambda df, columns: sorted(tuple(str(x) for x in r) for r in df.select(*columns).collect())
    assert rows(got.records, USERS_COLUMNS) == rows(want.records, USERS_COLUMNS)
    assert rows(got.rejects, ["key", "reject_reason", "lines"]) == rows(want.rejects, ["key", "reject_reason", "lines"])
    order = [r[0] for r in got.records.orderBy("_ingest_order").select("author_id").collect()]
    assert order == [r[0] for r in want.records.orderBy("_ingest_order").select("author_id").collect()]


def test_states_of_lines_are_those_of_one_line_after_the_other():
    codes = np.random.default_rng(1).integers(0, 4, 500)
    for state in (0, 1):
        want, at = [], state
        for code in codes:
            want.append(at := int(code) >> at & 1)
        assert splits.open_after(codes, state).tolist() == want
        assert splits.open_after(codes[:1], state).tolist() == want[:1]
