"""Headline queries, timed: prints one JSON line."""

from __future__ import annotations

import json
import os
import time

HEADLINE = ("frame_people", "nms_count", "nms_pose", "select_frame", "few_people_runs", "meta_row", "empty_runs", "range_median", "sorted_motion", "signing_boxes", "segment_cut", "segment_per_frame", "link_tracks", "signer_track", "match_boxes", "parity_accumulate", "gap_overlap", "merge_spans", "clean_cues", "meta_upsert", "resume_action")


def main() -> None:
    from pyspark.sql import SparkSession

    from rhapsode.plans import catalog

    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["frame_people"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # starts the engine
    took = {}
    for name in HEADLINE:
        began = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
