"""Shapes of plans: what is read, what is shuffled, where Python runs."""

import pytest

from textkiln import registry

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["canonical_urls", "url_policy_filter", "stable_paths", "body_hashes", "token_counts", "privacy_scan", "metadata_relevance", "line_offsets", "document_errors"])
def test_row_by_row_queries_do_not_shuffle(spark, name):
    p = plan(registry.QUERIES[name](spark, SF))
    assert "Exchange" not in p and "Python" not in p and "Pandas" not in p and "Arrow" not in p


@pytest.mark.parametrize("name, columns", [
    ("status_counts", {"event_type"}), ("first_turn_only", {"conv_id", "turn", "role", "text"}), ("canonical_urls", {"page_id", "url"}), ("estimated_tokens", {"doc_id", "text"}), ("render_markdown", {"page_id", "url", "html"}),
])
def test_only_needed_columns_are_read(spark, name, columns):
    schema = plan(registry.QUERIES[name](spark, SF)).split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in schema.split(",")} == columns


def test_filters_reach_the_scan(spark):
    assert "IsNotNull(user_id)" in plan(registry.QUERIES["event_windows"](spark, SF)).split("PushedFilters")[1]


@pytest.mark.parametrize("name, most", [("boilerplate_blocks", 2), ("exact_repetition", 2), ("per_source_totals", 1), ("change_classification", 2), ("event_fold", 1), ("usage_rollup", 2), ("state_upsert", 3)])
def test_shuffles(spark, name, most):
    p = plan(registry.QUERIES[name](spark, SF))
    assert p.count("Exchange hashpartitioning") <= most


#: Their results read tables that the query has written, so their plans say nothing of how these were made.
WRITTEN = {"incremental_recheck", "snapshot_differences", "combined_verification", "committed_updates", "stored_contents", "sitemap_worklist", "event_stream"}


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - WRITTEN))
def test_no_cross_join_of_tables(spark, name):
    if name in ("release_manifest", "publication_receipt"):
        pytest.skip("joins one-row aggregates")
    p = plan(registry.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_placements_are_shuffled_once(spark):
    p = plan(registry.QUERIES["guarded_placements"](spark, SF))
    assert p.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") <= 2  # the same one, for edits and for findings
