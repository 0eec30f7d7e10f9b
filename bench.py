"""Times of the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS], as one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from leafmill import catalog

HEADLINES = ("metadata_vectors", "smart_chunks", "hybrid_chunks", "hierarchical_chunks", "header_footer_strip", "paragraph_merge", "text_stats", "html_lines", "region_match_overlap", "reading_order", "structure_to_html")


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # The start of the session, its Python workers and the first compiled code belong to no query.
    for name in HEADLINES:
        catalog.QUERIES[name](spark, os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINES:
        start = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "total seconds of headline queries", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
