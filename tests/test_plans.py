"""Physical plans: no product of tables, filters and columns reach the scan."""

import pytest

from docgraph.catalog import QUERIES
from docgraph.plans import storage

PATH = "/root/testdata/sf0.001"
STREAMS = {n for n in QUERIES if n.startswith("stream_")}


def plan(spark, name):
    return QUERIES[name](spark, PATH)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_product_and_no_python(spark, name):
    text = plan(spark, name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in text, node


def test_scan_reads_only_what_is_needed(spark, monkeypatch):
    assert "ReadSchema: struct<doc_id:bigint>" in plan(spark, "score_importance").replace(" ...", "")
    # Rows are laid out by ranges first; the scan is below what is written.
    written, real = [], storage.stored
    monkeypatch.setattr(storage, "stored", lambda df, name: written.append(
        df._jdf.queryExecution().executedPlan().toString()) or real(df, name))
    final = plan(spark, "version_scd2")
    assert len(written) == 1 and "rangepartitioning(user_id" in written[0]
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in written[0]
    assert "EqualTo(event_type,signup)" in written[0]
    assert "ReadSchema: struct<user_id:bigint,ts:timestamp_ntz,_at:bigint>" in final


def test_topk_is_limited_before_the_shuffle(spark):
    text = plan(spark, "rank_topk")
    assert text.count("WindowGroupLimit") == 2
