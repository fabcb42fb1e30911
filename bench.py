"""Headline queries, timed one after another. Prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from vocabspark.plans import queries as q
from vocabspark.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Training comes before the queries that encode with what it learned, so those are timed alone.
NAMES = [
    "top_pieces_by_lang",
    "corpus_profile",
    "sample_shuffled",
    "normalize_nfc",
    "split_inference",
    "pretoken_counts",
    "byte_chars",
    "special_tokens",
    "byte_alphabet",
    "bpe_pair_counts",
    "unigram_seed",
    "merge_unigram_job",
    "reindex_bpe",
    "train_bpe",
    "train_bpe_1000_merges",
    "train_bpe_10000_merges",
    "train_unigram",
    "bpe_vocabulary",
    "encode_bpe",
    "encode_unigram",
    "decode",
    "token_frequency",
    "fallback_portion",
]


def run(spark, name: str) -> float:
    """Seconds to compute every row and column of a query."""
    start = time.perf_counter()
    if name == "bpe_vocabulary":
        q.bpe_vocabulary(spark, SF_DIR).tokens.count()
    elif name.endswith("_merges"):
        q.bpe_merges(spark, SF_DIR, int(name.split("_")[2])).count()
    else:
        q.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = local_session(CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    q.documents(spark, SF_DIR).count()
    seconds = {name: run(spark, name) for name in NAMES}
    total = round(sum(seconds.values()), 3)
    report = {
        "metric": "total_query_seconds",
        "value": total,
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
