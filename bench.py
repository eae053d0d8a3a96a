"""Time the headline queries. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from labelloom.plans.catalog import QUERIES  # noqa: E402
from labelloom.session import local_session  # noqa: E402

HEADLINE = ("tokenise", "preprocess", "word_ngrams", "dictionary_tokens", "side_table_join",
            "relevance_lookup", "document_frequency", "tfidf_words", "char_ngrams",
            "feature_union", "select_k_best", "mutual_information", "apply_fitted_features",
            "stratified_holdout", "stratified_folds", "evaluation_report", "roc_auc",
            "categorise_held_out", "train_and_predict_whole_text", "oob_curve_whole_text", "boosted_trees",
            "random_threshold_trees", "grid_search_whole_text", "sweep_selected_terms_whole_text", "enrich_articles")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, partitions=int(cores) if cores.isdigit() else 8, memory="12g")
    spark.read.parquet(f"{folder}/documents.parquet").count()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(folder).removeprefix("sf")}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
