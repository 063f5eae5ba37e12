"""Headline queries at BENCH_SF_DIR on local[BENCH_CPUS]; prints one JSON line.

The tables a collection stores, and the labels of its place tree, are written first and timed
on their own, as ``load``; that also warms the JVM.  Then each query runs once.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vitrine.catalog import all_queries
from vitrine.catalog.fixtures import STORED, collection
from vitrine.catalog.trees import place_tree
from vitrine.session import local_session

HEADLINE = (
    "k01_public_extract k02_internal_extract r02_metadata_extract r04_group_titles r06_acquisition_fields r10_dimensions r16_production_date "
    "r18_key_info r24_all_taxa r27_packing_list r31_objects_by_owner e08_total_counts e09_grouped_counts e10_latest_stats_wide e15_profile_columns "
    "d11_stitch d13_media_rows f01_rank_in_list f02_distinct_on f04_sequence_id h02_closure h08_culture_heading k08_scanner_moves b01_refname_display b04_collapse_ctrl_ws"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    times: dict[str, float] = {}

    start = time.time()
    tables = collection(spark, sf_dir)
    for name in STORED:
        tables[name]
    place_tree(tables)
    times["load"] = round(time.time() - start, 3)

    for name in HEADLINE:
        start = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline queries, total wall clock", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
