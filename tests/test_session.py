"""Sessions keep their settings; checkpoints need a shared folder off a local master."""

from types import SimpleNamespace

import pytest

from roasline import session


def test_running_session_keeps_its_settings(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        assert session.get_spark("local[2]") is not None
        assert spark.conf.get("spark.sql.shuffle.partitions") == "2000"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_cluster_without_shared_folder_is_an_error():
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    cluster = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(cluster)
