from neudrift.session import BROADCAST_ROWS, join_small, scratch_path, settle, workspace


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_workspace_is_the_checkpoint_folder(spark):
    root = workspace(spark)
    assert root == workspace(spark) == spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x").startswith(root) and scratch_path(spark, "x") != scratch_path(spark, "x")


def test_settle_keeps_rows(spark):
    assert sorted(r.id for r in settle(spark.range(5)).collect()) == [0, 1, 2, 3, 4]


def test_small_side_is_broadcast_only_within_the_bound(spark):
    left, right = spark.range(100), spark.range(10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(join_small(left, right, "id"))
        assert "SortMergeJoin" in plan(join_small(left, right, "id", at_most=BROADCAST_ROWS + 1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
