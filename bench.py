"""Time the headline queries on one data folder and print one JSON line.

``BENCH_SF_DIR`` names the folder, ``BENCH_CPUS`` the cores. Each query runs to the end with
all its columns (noop sink). The shared chunk table is a stage of its own: it is built
once, timed as ``prepare``, and the text queries after it start from its files.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "B1_extract_text",
    "B2_clean_section",
    "B4_core_lines",
    "C1_sentences",
    "C3_window_chunks",
    "C4_packed_chunks",
    "C9_python_chunks",
    "D1_embedding",
    "D2_request_groups",
    "E1_index_vectors",
    "E2_index_text",
    "E4_sync_stream",
    "E5_change_feed",
    "E8_one_per_key",
    "F1_nearest_vectors",
    "F2_nearest_text",
    "F4_filtered",
    "F5_probed_buckets",
    "F8_question_set",
    "G1_rerank",
    "H2_filled_template",
    "H5_chat_prompts",
    "H7_chat_history",
    "I4_totals",
    "J1_name_bucket",
]


def main() -> None:
    from gleaner.plans.catalog import REGISTERED
    from gleaner.plans.stages import prepare, prepared_frequencies
    from gleaner.session import local_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores)
    spark.read.parquet(f"{folder}/region.parquet").count()

    times: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)

    timed("prepare", lambda: (prepare(spark, folder), prepared_frequencies(spark, folder)))
    for name in HEADLINE:
        timed(name, lambda: REGISTERED[name](spark, folder).write.format("noop").mode("overwrite").save())
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
