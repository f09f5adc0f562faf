"""Wall time of the headline queries; prints one JSON line.

Every query runs once to warm up and then three times over the whole tables in
``$BENCH_SF_DIR``; the median counts. Results are computed in full and discarded.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from speechviews.catalogue import QUERIES  # noqa: E402
from speechviews.catalogue import inputs as I  # noqa: E402
from speechviews.catalogue.live import stream_counts_trained  # noqa: E402
from speechviews.catalogue.model import batch_view_trained, trained_model  # noqa: E402
from speechviews.plans.training import train  # noqa: E402
from speechviews.session import local_session  # noqa: E402

HEADLINE = [
    "segment_counts", "group_word_counts", "most_common_words", "batch_view_words", "batch_view_labelled",
    "view_request_join", "messages_deduped", "live_counts", "stream_live_counts", "term_frequencies", "tfidf_terms",
]
#: The two that score use the trained model here; the queries of that name have fixed weights.
TRAINED = {"batch_view_full": batch_view_trained, "stream_scored_counts": stream_counts_trained}
RUNS = 3


def timed(action):
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    reviews = I.reviews(spark, folder)
    actions = {"model_training": lambda: train(reviews, I.STOP_WORDS)}
    for name, build in {**{n: QUERIES[n] for n in HEADLINE}, **TRAINED}.items():
        actions[name] = lambda build=build: build(spark, folder).write.format("noop").mode("overwrite").save()
    trained_model(spark, folder)
    seconds = {}
    for name, action in actions.items():
        timed(action)
        seconds[name] = round(statistics.median(timed(action) for _ in range(RUNS)), 3)
    print(json.dumps({
        "metric": "sum of median query times", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
