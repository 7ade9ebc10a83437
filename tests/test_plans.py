"""Physical-plan guards for the scale claims: pruned scans and no Cartesian products."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
JOIN_HEAVY = ["range_nearest", "interp_lookup", "nearest_key", "subseq_match_sse", "asof_cross_copy",
              "guarded_override", "in_range_filter", "collapse_infrequent", "group_median_fill", "dedupe_first"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", JOIN_HEAVY)
def test_no_cartesian_product(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    # range-style predicates must not become a conditional nested-loop join
    assert "BroadcastNestedLoopJoin BuildRight, Inner, Some" not in plan
    assert "BroadcastNestedLoopJoin BuildLeft, Inner, Some" not in plan


def test_scan_is_pruned(spark):
    df = E.queries()["scan_projected"](spark, SF)
    df._jdf.queryExecution().executedPlan()  # force planning
    text = df._jdf.queryExecution().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_discount:double>" in text or \
        "l_orderkey:bigint,l_quantity:double,l_discount:double" in text


def test_seq_view_reads_only_needed_columns(spark):
    from stratum.plans import views
    text = views.seq(spark, SF).select("entity", "i")._jdf.queryExecution().executedPlan().toString()
    assert "props" not in text and "event_type" not in text


MEDIANS = ["box_stats_by_class", "blend_report", "group_median_fill", "train_median_fill", "simple_impute", "pooled_rmse", "median_gate",
           "segment_offsets", "knn_plane_impute"]


@pytest.mark.parametrize("name", MEDIANS)
def test_no_holistic_percentile(spark, name):
    """Medians and percentiles of data-sized groups go through bounded summaries, not through one map per group."""
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert " median(" not in plan and " percentile(" not in plan


@pytest.mark.parametrize("name", ["distinct_profile", "profile_table", "classify_columns", "quality_flags"])
def test_distinct_counts_copy_no_rows(spark, name):
    assert "Expand" not in _plan(E.queries()[name](spark, SF))


@pytest.mark.parametrize("name", ["savgol_smooth", "median_gate", "guarded_override", "subseq_match_ncc"])
def test_sequence_is_stored_once(spark, name, monkeypatch):
    """All branches of a query read one stored sequence: ``events`` is scanned twice, to count and to number its rows."""
    import re
    from stratum.plans import views
    plans, store = [], views.store_sequence

    def watched(df, *a):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return store(df, *a)
    monkeypatch.setattr(views, "store_sequence", watched)
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plans) == 1 and len(re.findall(r"Relation \[event_id", plans[0])) == 2
    assert "Relation [event_id" not in plan or "stratum_sequence" in plan


def test_stored_blocks_need_no_exchange(spark):
    """A window over the blocks of a stored sequence finds its rows together."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from stratum.plans import views
    with views.stored_views():
        s = views.seq(spark, SF, blocks=True)
    out = s.select("entity", "_blk", "i", F.sum("sig").over(Window.partitionBy("entity", "_blk").orderBy("i")).alias("c"))
    assert "Exchange" not in _plan(out)
