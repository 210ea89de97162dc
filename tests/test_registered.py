"""Registered queries against their SQL on the smallest data.

All of them with ``SHELFWISE_ALL=1``; otherwise one or two of each subject.
"""

import os
import re

import pytest

import __spark_entry__ as entry
from shelfwise.plans.registry import ORACLES, QUERIES
from tests.harness import check, connect

FOLDER = "/root/testdata/sf0.001"
SOME = ["modal_baseline", "cheapest_by_barcode", "price_exceptions", "domination_prune", "best_deal_per_product", "branch_lists",
        "category_rollup", "name_vote", "scan_resolution", "filler_words", "location_sanity", "ledger_comparison",
        "newest_file_per_branch", "promotion_files_to_offers", "shards_by_bytes", "stream_latest_value"]
# Operators of the optional subpackage have tests of their own.
OPTIONAL = {n for n in QUERIES if re.match(r"op\d+_|pipeline$", n)}
NAMES = sorted(set(entry.queries()) - OPTIONAL) if os.environ.get("SHELFWISE_ALL") else SOME


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test data here")
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, duck, name):
    problem, _, _ = check(spark, duck, name, entry.queries()[name], entry.oracle_sql().get(name), FOLDER)
    assert problem is None


def test_every_query_has_a_check():
    assert set(ORACLES) >= set(QUERIES) - OPTIONAL


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
