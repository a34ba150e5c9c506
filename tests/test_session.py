from cmdeval.session import scratch_path, shared_dir


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    base = shared_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(base.rstrip("/") + "/x-")


def test_existing_checkpoint_dir_is_kept(spark):
    before = spark.sparkContext.getCheckpointDir()
    assert shared_dir(spark) == before  # never replaced once set


def test_checkpoint_cuts_lineage_in_shared_dir(spark):
    df = spark.range(10).selectExpr("id * 2 AS x")
    cut = df.checkpoint(eager=True)
    assert cut.count() == 10 and "LogicalRDD" in cut._jdf.queryExecution().analyzed().toString()
