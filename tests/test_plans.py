"""Plan shape guards: the scale-relevant operators keep their work
partitioned (no nested-loop/cartesian joins, partial top-k, pushdown)."""

import re
import sys

from tokenmill.plans import q_retrieval, q_tokens, registry
import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["n_messages", "n_conversations", "p95_tokens"]


def test_registry_names():
    registry.load_all()
    for name in registry.QUERIES:
        assert re.fullmatch(r"[a-z0-9_]+", name)
        assert "pipeline" not in name and not re.match(r"op\d+_", name)


def test_packing_has_no_nested_loop(spark):
    p = _plan(q_tokens.tok9(spark, SF))
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_top_k_uses_group_limit(spark):
    from tokenmill.plans import q_retrieval as Q
    df = Q.win2(spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "Window" in plan


def test_retrieval_never_pairs_tables(spark):
    p = _plan(q_retrieval.jon2(spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scan_prunes_columns(spark):
    from tokenmill.plans import tables
    from pyspark.sql import functions as F
    df = tables.table(spark, SF, "documents").where(F.col("lang") == "en").select("doc_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in plan
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan


def test_queries_without_the_llm_subpackage(monkeypatch):
    """The other queries register where the subpackage is gone, with or without the pipeline's file."""
    monkeypatch.setitem(sys.modules, "tokenmill.llm", None)
    monkeypatch.delitem(sys.modules, "corpus_pipeline", raising=False)
    registry.load_all()
    assert set(entry.queries()) == set(registry.QUERIES)
    assert set(entry.oracle_sql()) == set(registry.ORACLE)
