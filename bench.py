"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is forced to completion with the ``noop`` sink (no collect to the driver),
after warm-up queries so JVM and Python-worker start-up are not charged to the first
measurement.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from voxspark.plans import all_queries  # noqa: E402,F401
from voxspark.plans.registry import REGISTRY  # noqa: E402
from voxspark.session import get_spark  # noqa: E402

HEADLINE = [
    "agg1_wer",                 # flagship: clean -> no-punct -> word distance -> corpus WER
    "agg3_quality_report",
    "scl8_clean_text",
    "src1_read_manifest",
    "agg6_corpus_stats",
    "win1_shard_even",
    "win5_number_repeats",
    "win10_bins_2d",
    "win12_plan_batches",
    "join2_attach_custom",
    "snk5_tar_shards",
    "agg12_word_freq",
    "tok2_train_bpe",
    "agg15_confidence_metrics",
    "join8_evaluate_grid",
    "str1_stream_manifest",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    # warm-up: JVM code paths and the Python workers used by the Arrow UDFs
    for w in ("agg4_manifest_counts", "scl10_no_punct"):
        REGISTRY[w].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        REGISTRY[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_seconds_headline_queries", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir}))


if __name__ == "__main__":
    main()
