from tidemark.session import checkpoint_dir, shared_dir


def test_shared_dir_lives_under_the_session_checkpoint_dir(spark):
    base = checkpoint_dir(spark)
    assert base == spark.conf.get("spark.checkpoint.dir")
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a != b and a.startswith(base.rstrip("/") + "/tidemark/x-")


def test_cluster_conf_sizes_partitions():
    from tidemark.session import cluster_conf

    conf = cluster_conf(100 * (1 << 40))  # 100 TiB shuffle
    assert conf["spark.sql.shuffle.partitions"] == str(100 * (1 << 40) // (256 << 20))
    assert cluster_conf(1 << 20)["spark.sql.shuffle.partitions"] == "200"
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
