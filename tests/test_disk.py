"""What stored builds leave on disk, and what they keep there meanwhile."""

from __future__ import annotations

import datetime as dt
import glob
import os
import time

import pyarrow.parquet as pq

from stratum.session import shuffles_freed
from stratum.streaming import by_name
from stratum.workload.queries import QUERIES

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _shuffle_files(spark):
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in local for f in glob.glob(f"{d}/*/shuffle_*.data")}


def _gone(spark, before):
    until = time.time() + 20  # they are removed in the background
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return not left


def _given_tables(spark, folder):
    day = dt.datetime(1997, 12, 20)
    given = {
        "customer": ([(k, f"C{k}", "BUILDING" if k % 2 else "AUTO") for k in range(1, 9)] + [(None, "none", None)],
                     "c_custkey long, c_name string, c_mktsegment string"),
        "part": ([(k, f"part {k}", ("LARGE", "PROMO")[k % 2], k, 10.5 + k) for k in range(1, 11)],
                 "p_partkey long, p_name string, p_type string, p_size int, p_retailprice double"),
        "orders": ([(k, k % 9, day + dt.timedelta(days=k)) for k in range(1, 31)] + [(31, None, day)],
                   "o_orderkey long, o_custkey long, o_orderdate timestamp"),
        "lineitem": ([(k % 31 + 1, k % 12, k % 5, float(k % 7), day + dt.timedelta(days=k % 40)) for k in range(200)] * 2 + [(None, 1, 1, 1.0, day)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_shipdate timestamp"),
    }
    for name, (rows, schema) in given.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def test_star_build_packs_its_files_and_leaves_no_shuffle_files(spark, tmp_dir):
    _given_tables(spark, tmp_dir)
    before, own = _shuffle_files(spark), spark.conf.get(_CLEANUP, None)
    fact = QUERIES["star_build_stored"](spark, tmp_dir)
    assert _gone(spark, before)
    assert spark.conf.get(_CLEANUP, None) == own

    straight = QUERIES["fact_sales"](spark, tmp_dir).select(*fact.columns)
    assert fact.count() == straight.count() > 400   # every line, some in two versions
    assert fact.exceptAll(straight).count() == 0 and straight.exceptAll(fact).count() == 0

    root = fact.inputFiles()[0].removeprefix("file://").split("/gold/")[0]
    raw = glob.glob(f"{root}/raw/*/*/part-*")
    assert raw and all(f.endswith(".csv.gz") for f in raw)
    for layer in ("bronze", "silver", "gold"):
        stored = [f for f in glob.glob(f"{root}/{layer}/**/*.parquet", recursive=True) if "/layouts/" not in f]
        codecs = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in stored if pq.ParquetFile(f).metadata.num_row_groups}
        assert codecs == {"ZSTD"}, layer


def test_shuffles_freed_nests_and_restores_the_setting(spark, tmp_dir):
    own = spark.conf.get(_CLEANUP, None)
    before = _shuffle_files(spark)
    with shuffles_freed(spark):
        with shuffles_freed(spark):
            pass
        assert spark.conf.get(_CLEANUP) == "true"
        spark.range(1000).repartition(4).write.parquet(f"{tmp_dir}/t")
    assert _gone(spark, before) and spark.conf.get(_CLEANUP, None) == own
    spark.conf.set(_CLEANUP, "false")
    try:
        with shuffles_freed(spark):
            assert spark.conf.get(_CLEANUP) == "true"
        assert spark.conf.get(_CLEANUP) == "false"
    finally:
        spark.conf.unset(_CLEANUP) if own is None else spark.conf.set(_CLEANUP, own)


def test_headers_are_found_without_sorting_the_lines(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/raw")
    for i in range(3):
        with open(f"{tmp_dir}/raw/f{i}.csv", "w") as fh:
            fh.write("\n" * i + ("CID,CNTRY\n" if i else "cntry,cid\n") + "".join(f"{i}{j},x\n" for j in range(50)) + "CID,CNTRY\n")
    layouts = []
    rows = by_name.map_by_header(spark.read.text(f"{tmp_dir}/raw").select("value", "_metadata"), "loc_a101", layouts.extend)
    assert sorted(layouts) == [["CID", "CNTRY"], ["cntry", "cid"]]
    got = sorted((r["CID"], r["CNTRY"]) for r in rows.collect())
    lines = [("x", f"0{j}") for j in range(50)] + [(f"{i}{j}", "x") for i in (1, 2) for j in range(50)]
    assert got == sorted([*lines, ("CNTRY", "CID"), ("CID", "CNTRY"), ("CID", "CNTRY")])  # only a first line is a header
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "BroadcastHashJoin" in plan
