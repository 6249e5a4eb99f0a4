"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``: one warm-up run, then ``$BENCH_RUNS`` (default 3) timed
runs into the ``noop`` sink; reports the median per query and their sum as ONE JSON
line on stdout.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pyspark  # noqa: E402

from feedworks.plans.catalogue import QUERIES  # noqa: E402
from feedworks.session import get_session  # noqa: E402

# The database suite's eight statements, the file suite, keep-first, edge explode +
# dedup, the quality split, the quote-aware list parse over documents, and the
# users import on a feed derived from lineitem.
HEADLINE = [
    "count_all", "filter_counts", "update_count", "suite_deleted", "suite_grouped",
    "suite_joined", "file_suite_bands", "file_suite_high_female", "conditional_summary",
    "keep_first", "keep_first_existing", "edge_dedup", "quality_rejects", "parse_steps",
    "split_quoted_compat", "import_users", "import_followers", "import_recipes",
    "import_instructions", "import_reviews", "fk_valid", "cascade_delete",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", app_name="feedworks-bench",
                        shuffle_partitions=int(cpus) * 2,
                        # the given tables have one row group each: a scan can't split them
                        extra_conf={"spark.driver.memory": "16g", "feedworks.input.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in names:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        spark.catalog.clearCache()
        samples = []
        for _ in range(runs):
            # Plan and run from scratch each time: a query that persists an
            # intermediate pays for filling it in every timed run.
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
            spark.catalog.clearCache()
        timings[name] = round(statistics.median(samples), 4)
        print(f"# {name}: {timings[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "sum_of_median_query_seconds", "value": round(sum(timings.values()), 4),
           "unit": "sec", "queries": timings, "sf": sf, "cpus": int(cpus), "runs": runs,
           "spark": pyspark.__version__}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
