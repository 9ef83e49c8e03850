"""Shared-folder helpers: checkpoints and scratch data stay under the folder
the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

from stratum.session import ensure_checkpoint_dir, scratch_path, scratch_scope


def test_checkpoint_dir_is_registered_and_stable(spark):
    first = ensure_checkpoint_dir(spark)
    assert first and ensure_checkpoint_dir(spark) == first
    assert spark.sparkContext.getCheckpointDir() == first
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:                      # the cluster's folder wins over any default
        assert configured.rstrip("/").split(":")[-1] in first


def test_scratch_paths_are_unique_and_shared(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b
    base = ensure_checkpoint_dir(spark).rstrip("/")
    assert a.startswith(base) and b.startswith(base)


def test_scratch_scope_frees_what_it_made(spark):
    import os
    outside = scratch_path(spark, "kept")
    spark.range(3).write.parquet(outside)
    with scratch_scope(spark):
        inside = scratch_path(spark, "freed")
        spark.range(3).write.parquet(inside)
        assert spark.read.parquet(inside).count() == 3
    assert not os.path.exists(inside.removeprefix("file:")) and spark.read.parquet(outside).count() == 3
