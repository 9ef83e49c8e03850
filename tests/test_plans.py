"""Plan shape of registered queries: the properties the scale design relies
on, checked on the physical plans Spark actually builds."""

from __future__ import annotations

import re

import __spark_entry__ as entry
from conftest import SF_SMALL


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()   # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_lookups_broadcast_small_dimensions(spark):
    plan = executed(entry.queries()["fact_sales"](spark, SF_SMALL))
    assert "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") >= 2


def test_keep_latest_limits_before_the_shuffle(spark):
    plan = executed(entry.queries()["keep_latest_hot_groups"](spark, SF_SMALL))
    assert re.search(r"WindowGroupLimit .*Partial", plan)
    assert re.search(r"WindowGroupLimit .*Final", plan)


def test_version_end_aggregates_before_its_window(spark):
    df = entry.queries()["version_end_date"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    window = plan.find("Window [lead(")
    assert window >= 0 and plan.find("HashAggregate", window) > window


def test_scans_read_only_needed_columns(spark):
    df = entry.queries()["clean_sales_details"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = re.search(r"FileScan parquet \[([^\]]*)\][^\n]*lineitem\.parquet", plan)
    assert scan is not None
    cols = {c.split("#")[0] for c in scan.group(1).split(",")}
    assert cols == {"l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"}


def test_row_wise_jobs_shuffle_nothing_below_their_join(spark):
    """The derived sales feed joins lines to orders; the row-wise job adds no exchange of its own."""
    for name in ("guarded_dates", "clean_sales_details"):
        plan = executed(entry.queries()[name](spark, SF_SMALL))
        assert "REPARTITION" not in plan
        if "BroadcastHashJoin" in plan:
            assert "Exchange hashpartitioning" not in plan


def test_upsert_without_uniqueness_check_groups_nothing(spark, tmp_dir):
    """Which buckets a source touches is read off its written folders."""
    from stratum.sinks import tables

    path = f"{tmp_dir}/t"
    tables.write_table(spark.range(1000).withColumnRenamed("id", "k"), path, keys=["k"], buckets=4)
    calls = []
    original = tables._check_unique
    tables._check_unique = lambda *a: calls.append(a)
    try:
        tables.replace_by_keys(spark, path, spark.range(5).withColumnRenamed("id", "k"), ["k"])
    finally:
        tables._check_unique = original
    assert not calls and tables.read_table(spark, path).count() == 1000
