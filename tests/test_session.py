from sediment.session import scratch, session_conf, shared_dir


def test_shuffle_partitions_follow_the_data():
    assert session_conf(10, 8)["spark.sql.shuffle.partitions"] == "8"
    assert session_conf(100 << 40, 8)["spark.sql.shuffle.partitions"] == str((100 << 40) // (128 << 20))


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark, "x").startswith(shared_dir(spark)) and scratch(spark, "x") != scratch(spark, "x")
