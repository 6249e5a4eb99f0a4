import os
import shutil
import tempfile

import pytest
from pyspark.errors import AnalysisException
from test_feeds import USERS_CSV

from feedworks import streaming
from feedworks.schemas import RECIPES_COLUMNS
from feedworks.streaming.feed_stream import existing


def test_incremental_users_import(spark):
    src = tempfile.mkdtemp(prefix="feedworks-src-")
    out = tempfile.mkdtemp(prefix="feedworks-out-")
    ckpt = tempfile.mkdtemp(prefix="feedworks-ck-")
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write(USERS_CSV)
    q = streaming.start(spark, src, out, "users", checkpoint=ckpt, multi_line=True)
    q.awaitTermination(120)
    users = {r.author_id: r.author_name for r in spark.read.parquet(out + "/users").collect()}
    assert users == {1: "Alice", 2: "Bob", 7: "Gina", 8: "Hal\nJones", 12: "Jo"}
    # a later file: key 1 is already loaded (kept), key 20 is new, edge 20->1 is new
    with open(os.path.join(src, "b.csv"), "w") as f:
        f.write("h1,h2,h3,h4,h5,h6,h7,h8\n1,Other,Male,40,0,0,,\n20,Zed,Male,40,0,0,\"1,2\",\n")
    q = streaming.start(spark, src, out, "users", checkpoint=ckpt, multi_line=True)
    q.awaitTermination(120)
    users = {r.author_id: r.author_name for r in spark.read.parquet(out + "/users").collect()}
    assert users[1] == "Alice" and users[20] == "Zed" and len(users) == 6
    edges = sorted((r.user_id, r.follower_id) for r in spark.read.parquet(out + "/user_followers").collect())
    assert (20, 1) in edges and (20, 2) in edges and (1, 2) in edges
    assert len(edges) == len(set(edges))
    shutil.rmtree(ckpt, ignore_errors=True)


def test_recipes_stream_checks_authors(spark):
    src, out, ckpt = (tempfile.mkdtemp(prefix=f"feedworks-{n}-") for n in ("src", "out", "ck"))
    spark.createDataFrame([(1,)], "author_id int").write.parquet(out + "/known")
    cells = {c: "" for c in RECIPES_COLUMNS}
    with open(os.path.join(src, "r.csv"), "w") as f:
        f.write(",".join(RECIPES_COLUMNS) + "\n")
        for key, author in (("10", "1"), ("11", "999"), ("12", "")):
            f.write(",".join({**cells, "recipe_id": key, "recipe_name": "Pie", "author_id": author}.values()) + "\n")
    streaming.start(spark, src, out, "recipes", checkpoint=ckpt, users=out + "/known").awaitTermination(120)
    assert sorted(r.recipe_id for r in spark.read.parquet(out + "/recipes").collect()) == [10, 12]
    reasons = {(r.key, r.reject_reason) for r in spark.read.parquet(out + "/recipes_rejects").collect()}
    assert ("11", "fk:author_id") in reasons


def test_only_a_missing_path_means_no_target_yet(spark):
    there = tempfile.mkdtemp(prefix="feedworks-out-")
    assert existing(spark, there + "/none") is None
    with pytest.raises(AnalysisException):
        existing(spark, there)  # a folder without a schema is no first load
