from pyspark.sql import functions as F

from feedworks.operators import changes, flatten, quality, reports, upsert


def _key(row):
    return tuple((v is not None, v) for v in row)


def rows(df, *cols):
    src = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in src.collect()), key=_key)


def test_keep_first_by_order_and_by_all_columns(spark):
    df = spark.createDataFrame(
        [(1, "b", 2), (1, "a", 3), (2, "z", 1), (2, None, 5), (3, "c", 1)], "k int, v string, o int")
    assert rows(upsert.keep_first(df, "k", order="o")) == [(1, "b", 2), (2, "z", 1), (3, "c", 1)]
    # no order: all remaining columns ascending, nulls first
    assert rows(upsert.keep_first(df, "k")) == [(1, "a", 3), (2, None, 5), (3, "c", 1)]


def test_keep_first_plan_aggregates_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = upsert.keep_first(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_keep_first_append_never_overwrites(spark):
    existing = spark.createDataFrame([(1, "old")], "k int, v string")
    new = spark.createDataFrame([(1, "new"), (2, "b2"), (2, "a2")], "k int, v string")
    assert rows(upsert.keep_first_append(new, existing, "k")) == [(1, "old"), (2, "a2")]


def test_dedup_and_append_pairs(spark):
    e = spark.createDataFrame([(1, 2), (1, 2), (2, 2)], "u int, f int")
    old = spark.createDataFrame([(2, 2)], "u int, f int")
    assert rows(upsert.dedup_pairs(e, ["u", "f"])) == [(1, 2), (2, 2)]
    assert rows(upsert.append_pairs(e, old, ["u", "f"])) == [(1, 2)]


def test_quality_split_check_semantics(spark):
    df = spark.createDataFrame([(1, "Male", 30), (2, "X", 30), (3, None, None), (4, "Female", 0),
                                (5, "Female", 121)], "id int, g string, age int")
    rules = [quality.in_set("g", ["Male", "Female"]),
             quality.in_range("age", 0, 120, low_inclusive=False)]
    ok, bad = quality.split(df, rules)
    assert rows(ok, "id") == [(1,), (3,)]           # NULL passes a CHECK
    assert rows(bad, "id", "reject_reason") == [(2, "in_set:g"), (4, "range:age"), (5, "range:age")]
    counts = dict(rows(quality.rule_counts(df, rules)))
    assert counts == {"in_set:g": 1, "range:age": 2}


def test_fits_rule_and_fk_split(spark):
    df = spark.createDataFrame([(1, "5", 5), (2, "x", None), (3, None, None)], "id int, raw string, v int")
    ok, bad = quality.split(df, [quality.fits("raw", "v", "v")])
    assert rows(bad, "id") == [(2,)]
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, fk int")
    parent = spark.createDataFrame([(10,), (10,), (11,)], "pk int")
    ok, bad = quality.fk_split(child, "fk", parent, "pk")
    assert rows(ok) == [(1, 10), (3, None)]
    assert rows(bad) == [(2, 99, "fk:fk")]
    assert rows(quality.cascade_delete(child, "fk", parent.filter("pk = 10"), "pk"), "id") == [(2,), (3,)]


def test_update_and_delete(spark):
    df = spark.createDataFrame([(1, 20, 5), (2, 40, 7), (3, None, 9), (4, 60, None)],
                               "id int, age int, f int")
    upd = changes.update_where(df, "f", F.col("f") + 1, F.col("age") < 30)
    assert rows(upd) == [(1, 20, 6), (2, 40, 7), (3, None, 9), (4, 60, None)]
    assert changes.affected(df, F.col("age") < 30).first()[0] == 1
    assert rows(changes.delete_where(df, F.col("age") > 50), "id") == [(1,), (2,), (3,)]
    assert rows(changes.delete_in_limit(df, "id", F.col("age") > 10, 2), "id") == [(3,), (4,)]


def test_reports_group_and_counts(spark):
    df = spark.createDataFrame([("F", 25, 10.0, 1), ("F", 30, 20.0, 2), ("M", 35, 5.0, 3),
                                (None, 22, 7.0, 4), ("M", 50, 1.0, 5)], "g string, age int, f double, x int")
    c = reports.filter_counts(df, {"a": reports.between("age", 25, 35), "b": reports.greater("f", 6)}).first()
    assert (c.a, c.b) == (3, 3)
    out = reports.group_having_sort(df, "g", {"avg_f": "f", "avg_x": "x"},
                                    pred=reports.between("age", 20, 40), min_count=0)
    assert [tuple(r) for r in out.collect()] == [("F", 15.0, 1.5, 2), (None, 7.0, 4.0, 1), ("M", 5.0, 3.0, 1)]
    bands = rows(reports.decade_average(df, "age", "f", avg_name="a"))
    assert bands == [(20, 8.5), (30, 12.5), (50, 1.0)]


def test_above_global_avg(spark):
    df = spark.createDataFrame([("female", 10.0), ("F", 1.0), ("male", 30.0), (None, 50.0)], "g string, f double")
    out = reports.above_global_avg(df, "f", reports.any_case_in("g", ["female", "f"]))
    assert rows(out) == []
    out = reports.above_global_avg(df, "f")
    assert rows(out, "f") == [(30.0,), (50.0,)]


def literal_plan(users, edges, user_key, edge_user, edge_target, group_col, value_col, pred=None):
    """What left_join_distinct computes, as its SQL says it."""
    u = users if pred is None else users.filter(pred)
    j = u.join(edges, u[user_key] == edges[edge_user], "left")
    out = j.groupBy(u[group_col]).agg(F.countDistinct(edges[edge_target]).alias("unique_followers"),
                                      F.avg(u[value_col]).alias("avg_followers"))
    return out.filter(F.col("unique_followers") > 0)


def test_left_join_distinct_equals_literal_plan(spark):
    users = spark.createDataFrame(
        [(1, "F", 30, 10), (2, "F", 40, None), (3, "M", 20, 4), (4, "M", 70, 8), (5, None, 30, 1),
         (6, "X", 30, 3)], "id int, g string, age int, fc int")
    edges = spark.createDataFrame(
        [(1, 7), (1, 7), (1, 8), (2, 9), (3, None), (5, 7), (9, 1)], "uid int, fid int")
    args = (users, edges, "id", "uid", "fid", "g", "fc", reports.between("age", 18, 60))
    fast = rows(reports.left_join_distinct(*args))
    plain = rows(literal_plan(*args))
    assert fast == plain
    assert ("F", 3, 10.0) in fast           # user 1 counted once per edge row: (10*3)/3


def test_flatten_steps_and_ids(spark):
    df = spark.createDataFrame([(1, 'c("mix", "", "bake, then cool")', "1, 2,x,1"),
                                (2, None, "NULL")], "id int, steps string, ids string")
    steps = rows(flatten.explode_steps(df, "id", F.col("steps")))
    assert steps == [(1, 1, "mix"), (1, 2, "bake, then cool")]
    ids = rows(flatten.explode_ids(df, "id", F.col("ids"), "fid"))
    assert ids == [(1, 1), (1, 1), (1, 2)]
    no_self = rows(flatten.explode_ids(df, "id", F.col("ids"), "fid", drop_self=True))
    assert no_self == [(1, 2)]
    with_id = flatten.with_surrogate_id(df, "sid")
    assert with_id.select("sid").distinct().count() == 2


def test_timing_summary(spark):
    t = spark.createDataFrame([("count", 2.0), ("count", 4.0), ("join", 9.0)], "op string, ms double")
    out = rows(reports.timing_summary(t, base_op="count"))
    assert out == [("count", 3.0, 2, 1.0), ("join", 9.0, 1, 3.0)]


def test_hot_foreign_key_is_split(spark):
    """A key with a third of the rows: the final plan splits its partition."""
    old = {k: spark.conf.get(k, None) for k in (
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor")}
    try:
        for k, v in zip(old, ("-1", "-1", "16k", "16k", "2")):
            spark.conf.set(k, v)
        child = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("fk"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        parent = spark.range(0, 30000, 1, 4).select(F.explode(F.array("id", "id")).alias("pk"))  # keys repeat
        ok, bad = quality.fk_split(child, "fk", parent, "pk")
        for df in (ok, quality.semi(child, "fk", parent, "pk"), quality.anti(child, "fk", parent, "pk")):
            df.write.format("noop").mode("overwrite").save()
            df.collect()
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
        assert ok.count() + bad.count() == 60000 and bad.filter(F.col("fk") < 30000).count() == 0
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
