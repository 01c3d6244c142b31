import re

import pytest

from textloom.plans.catalog import CATALOG


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name,columns", [("canonical_url", {"page_id", "url"}), ("min_chars", {"doc_id", "text", "n_chars"}), ("dedup_stats", {"text"}), ("json_props", {"event_id", "props"}), ("train_valid_split", {"conv_id", "turn"}), ("exact_dedup", {"doc_id", "text", "source"})])
def test_scans_read_what_is_used(spark, sf, name, columns):
    read = [set(re.findall(r"(\w+):", x)) for x in re.findall(r"ReadSchema: struct<(.*?)>\n", plan(CATALOG[name].run(spark, sf)) + "\n")]
    assert read and all(r <= columns for r in read)


@pytest.mark.parametrize("name", ["bm25_topk", "knn_self_join", "dense_topk", "rrf_fusion", "exact_dedup", "chunk_dedup", "epoch_pairs", "query_batches", "target_stop", "cosine_dedup_candidates", "manifest_incremental", "grounded_sources"])
def test_no_cartesian_product(spark, sf, name):
    assert "CartesianProduct" not in plan(CATALOG[name].run(spark, sf))


@pytest.mark.parametrize("name", ["canonical_url", "html_text", "noise_filter", "trim_noise_edges", "sliding_window_chunks", "context_block", "extract_links", "validate_ids", "epoch_pairs", "bm25_topk"])
def test_stays_in_the_engine(spark, sf, name):
    assert not re.search("ArrowEvalPython|BatchEvalPython|MapInArrow|MapInPandas|FlatMapGroups", plan(CATALOG[name].run(spark, sf)))


def test_filters_reach_the_scan(spark, sf):
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(role,user\)", plan(CATALOG["query_ids"].run(spark, sf)))


@pytest.mark.parametrize("name", ["learned_reranker", "search_hits", "rerank_hits", "context_block", "grounded_sources", "pair_texts", "qa_dataset", "source_chunk_lookup", "query_packs", "direct_vs_rag", "judge_summary", "cap_negatives", "random_negatives"])
def test_a_search_is_done_once_and_only_found_texts_are_shuffled(spark, sf, monkeypatch, name):
    from textloom.operators import retrieve

    calls, few, real = [], [], retrieve.only
    search_ = retrieve.bm25
    monkeypatch.setattr(retrieve, "bm25", lambda *a, **b: calls.append(1) or search_(*a, **b))
    monkeypatch.setattr(retrieve, "only", lambda *a: few.append(real(*a)) or few[-1])
    p = plan(CATALOG[name].run(spark, sf))
    assert len(calls) == 1 and "keys:array" not in p  # the plan reads the stored answers, not the index
    assert all("BroadcastHashJoin" in plan(f) and "LeftSemi" in plan(f) for f in few) and (few or name in ("cap_negatives", "random_negatives"))
