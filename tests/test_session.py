from memberlens.session import checkpoint_root, materialize, scale_settings, scratch_dir


def test_checkpoint_root_is_the_session_setting(spark):
    root = checkpoint_root(spark)
    assert root == spark.sparkContext.getConf().get("spark.checkpoint.dir").rstrip("/")
    assert scratch_dir(spark, "x").startswith(root + "/x-")


def test_materialize_cuts_lineage(spark):
    df = spark.range(100).selectExpr("id", "id % 7 as k").groupBy("k").count()
    cut = materialize(df)
    assert cut.count() == 7
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan          # reads the checkpoint, not the aggregation


def test_scale_settings():
    conf = scale_settings(100 * 1024 ** 4, cores=8000)     # 100 TB on 8000 cores
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert scale_settings(1024, cores=8)["spark.sql.shuffle.partitions"] == "24"


def test_the_bench_times_every_registered_query():
    import __spark_entry__ as E
    import bench
    registered = E.queries()
    assert "user_tag" in registered and bench.chosen(registered, []) == list(registered)
    assert bench.chosen(registered, ["member_sex"]) == ["member_sex"]
