"""Plan shape: native queries stay in the JVM, the containment join is broadcast,
the running index never runs as one unpartitioned window over all rows, and pruning
reaches the scan."""

import pytest

from termweave.plans.queries import QUERIES
from tests.conftest import SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")
PYTHON_OK = {"generate_batches", "translate_batches"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - PYTHON_OK - {"incremental_mine"}))
def test_no_python_in_native_queries(spark, name):
    plan = _plan(QUERIES[name](spark, SMALL))
    assert not any(n in plan for n in PYTHON_NODES), name


def test_flagship_uses_broadcast_containment_join(spark):
    plan = _plan(QUERIES["best_sentence"](spark, SMALL))
    assert "BroadcastHashJoin" in plan and "Contains" in plan


def test_documents_scan_is_pruned(spark):
    from termweave.plans.queries import clean_text

    plan = _plan(clean_text(spark, SMALL))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_ranked_tokens_use_window_group_limit(spark):
    from termweave.plans.fixtures import Fixtures

    plan = _plan(Fixtures(spark, SMALL).ranked_tokens())
    assert "WindowGroupLimit" in plan


def test_enrichment_takes_first_links_with_window_group_limit(spark):
    plan = _plan(QUERIES["enrich_terms"](spark, SMALL))
    assert "WindowGroupLimit" in plan
