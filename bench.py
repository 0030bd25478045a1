"""Headline timings: runs the main corpus jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query is fully executed through the no-op sink (nothing is collected).
Before timing, a few queries run once on the smallest scale factor (same
code paths: JIT compilation, Python worker start); those runs are not timed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from trawl.plans.catalog import QUERIES  # noqa: E402
from trawl.session import get_spark  # noqa: E402
from trawl.sources.tables import table  # noqa: E402

HEADLINE = ["gopher_filter", "text_kept_ratio", "mask_pii", "pii_totals", "normalize_text",
            "line_frequencies", "dedup_lines", "strip_tags", "pages_to_text", "dedup_minhash_fast",
            "curate_summary_fast", "dedup_minhash", "scan_warc", "scan_wet", "write_filtered_wet",
            "identify_language", "classify_toxic", "document_frequency", "pack_windows", "sample_windows",
            "global_rank_documents", "archive_records", "exact_jaccard_documents", "sample_half", "sentence_counts"]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark("trawl-bench", master=f"local[{cpus}]", shuffle_partitions=cpus * 2,
                      extra={"spark.driver.memory": "16g"})
    # warm-up: JIT and Python workers, not timed
    table(spark, sf, "documents").select(F.length("text")).write.format("noop").mode("overwrite").save()
    small = os.environ.get("BENCH_WARMUP_SF_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(small):
        for name in ("gopher_filter", "mask_pii", "pages_to_text"):
            QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
    jobs = {k: QUERIES[k] for k in HEADLINE}
    times = {}
    for name, fn in jobs.items():
        t0 = time.time()
        fn(spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
