"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. Every
query is run to the end over its whole tables, once, after one warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfwise.plans import queries as _queries  # noqa: E402,F401
from shelfwise.plans.registry import QUERIES  # noqa: E402
from shelfwise.session import build_session  # noqa: E402

HEADLINE = [
    "latest_observation", "modal_baseline", "price_exceptions", "cheapest_by_barcode", "cheapest_word_in_city",
    "price_tiers", "offer_merge_on_terms", "shelf_priced_offers", "domination_prune", "best_deal_per_product",
    "branch_list_modes", "store_bits", "category_rollup", "name_vote", "scan_resolution", "filler_words", "bm25_top_documents",
    "stores_near_every_customer", "ledger_comparison", "newest_file_per_branch", "shards_by_bytes",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    run = lambda name: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    run("modal_baseline")
    took = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run(name)
        took[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline queries, total time", "value": round(sum(took.values()), 3), "unit": "sec",
                      "queries": took, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
