"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from corpusloom.queries import registry
from corpusloom.session import session

HEADLINE = [
    "keywords_top10", "corpus_term_counts", "doc_term_ids", "page_text", "upsert_count", "segment_dict", "nb_model", "nb_top2",
    "stream_term_counts",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        f"local[{cpus}]", "corpusloom-bench", spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = registry()
    # Start-up of the engine is not part of any query.
    known["tag_counts"][0](spark, folder).collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        known[name][0](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
