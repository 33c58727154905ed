"""Headline queries, full result forced through the noop sink: median of three runs after one warm-up.

The first run of a query is told as "cold": it also derives the domain's stored tables (click log, merged log,
documents, dictionary) where no query before it did, and compiles code. The "queries" figures are warm: the
operators over Parquet.

Prints one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores; names on the command line
choose queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HEADLINE = [
    "f11_host_profile", "c1_canonicalise", "f1_merge_duplicates", "f2_frequency_dictionary", "i12_event_index",
    "i15_pack_weeks", "i9_tuple_tokens", "i16_sequence_chunks", "j5_auc", "j6_weighted_f1", "j14_mix",
    "g1_stratified_split", "d4_visible_text", "e4_normalise_tokens", "h2_text_vector", "h5_own_embedding_index",
    "a9_write_user_buckets", "k1_user_vectors",
]


def main() -> None:
    from clickfolk.catalog.registry import all_queries
    from clickfolk.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.log.level": "ERROR",
    })
    queries = all_queries()
    seconds, cold = {}, {}
    for name in sys.argv[1:] or HEADLINE:
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            queries[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name], cold[name] = round(statistics.median(runs[1:]), 3), round(runs[0], 3)
        print(name, "cold", cold[name], "warm", seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "cold": cold,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
