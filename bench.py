"""Benchmark the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set), BENCH_REPEAT (2).
Prints one JSON line. Each query is built and executed in full through the
``noop`` sink (no collect to the driver); the best of BENCH_REPEAT runs is
reported, so plan compilation on first use is not counted, and the first
run's time is reported next to it. The given tables are single files of one row
group, which one task reads; as large tables are not, the text tables are written
once as part files, outside the timing, and the queries read those. One more run of
each query on the tables as given is reported as ``single_file``.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "semantic_search", "token_chunks", "embed_hash", "html_sections", "upsert_merge",
    "kg_reachable", "kg_shortest_path", "topk_multi", "lemmatize", "doc_profile",
    "render_prompts", "kg_context_depth",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))

    from docweave.session import get_spark
    scratch = tempfile.mkdtemp(prefix="docweave-bench-")
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), extra={
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
        "spark.local.dir": os.path.join(scratch, "local"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    from docweave.plans.registry import queries
    qs = queries()

    # warm-up: JVM codegen and Python workers, not timed
    qs["clean_text"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    given, sf_dir = sf_dir, os.path.join(scratch, os.path.basename(sf_dir))
    os.makedirs(sf_dir)
    for table in sorted(os.listdir(given)):
        if table.split(".")[0] in ("documents", "embeddings", "pages", "lineitem", "orders", "conversations", "events"):
            spark.read.parquet(os.path.join(given, table)).repartition(2 * cpus).write.parquet(os.path.join(sf_dir, table))
        else:
            os.symlink(os.path.join(given, table), os.path.join(sf_dir, table))

    timings, first, single = {}, {}, {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, given).write.format("noop").mode("overwrite").save()
        single[name] = round(time.perf_counter() - t0, 3)
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        timings[name] = round(min(runs), 3)
        first[name] = round(runs[0], 3)
    sf = os.path.basename(given).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": cpus, "repeat": repeat,
                      "first_run": first, "first_run_total": round(sum(first.values()), 3),
                      "single_file": single, "single_file_total": round(sum(single.values()), 3)}))
    spark.stop()


if __name__ == "__main__":
    main()
