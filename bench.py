"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS
(default 2; the best run counts) and BENCH_QUERIES (comma-separated names) steer it.
Every query is run in full and its rows are discarded by the noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from corpuslens.session import build_session, release, ship_code  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "p03_full_cleaning",
    "t02_word_punct_tokens",
    "t03_wordpiece_ids",
    "t04_unigram_ids",
    "t06_length_coverage",
    "p06_stem_words",
    "m02_ratio_split",
    "m06_epoch_shuffle",
    "a03_median_text_length",
    "a08_top_words",
    "a09_top_ngrams",
    "a11_log_odds",
    "a15_corpus_report",
    "l02_ngram_counts",
    "l05_laplace_probability",
    "l07_perplexity_laplace",
    "l08_generated_sentences",
    "v10_temperature_sentences",
    "v01_vocabulary",
    "v06_padded_batches",
    "v07_decoded_documents",
    "c02_count_per_tokenisation",
    "e05_metrics_per_split",
    "g02_pairwise_agreement",
    "k04_resolved_responses",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__driver__memory="16g", spark__sql__shuffle__partitions=cpus,
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir="file://" + tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_code(spark, HERE, "corpuslens", "workload")
    best: dict[str, float] = {}
    for name in names:
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken = time.perf_counter() - start
            best[name] = min(taken, best.get(name, taken))
            release(spark)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(best.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in best.items()},
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
