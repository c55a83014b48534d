"""Shared-folder helpers: checkpoints and scratch output live under the session's folder."""

from tilescope.config import broadcast_if_bounded, checkpoint_dir, materialize, scratch_path


def test_scratch_paths_are_unique_and_shared(spark):
    root = checkpoint_dir(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b
    assert a.startswith(root.rstrip("/") + "/tilescope-scratch/")


def test_materialize_is_a_reliable_checkpoint(spark):
    df = materialize(spark.range(10))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" in plan or "Scan" in plan
    assert df.count() == 10
    assert spark.sparkContext.getCheckpointDir()


def test_broadcast_only_with_a_bound(spark):
    df = spark.range(5)
    hinted = broadcast_if_bounded(df, 5).join(spark.range(100), "id")
    plain = broadcast_if_bounded(df, None).join(spark.range(100), "id")
    over = broadcast_if_bounded(df, 10**9).join(spark.range(100), "id")
    assert "broadcast" in hinted._jdf.queryExecution().analyzed().toString().lower() or \
        "BroadcastHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()
    for d in (plain, over):
        assert "ResolvedHint" not in d._jdf.queryExecution().analyzed().toString()
