"""Session helpers: shared work folder and cluster settings."""

import pytest

from perkflow.session import _fallback_dir, cluster_conf, ensure_checkpoint_dir, scratch_path


def test_work_folder_comes_from_the_session(spark):
    d = ensure_checkpoint_dir(spark)
    assert d == spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(d.rstrip("/") + "/x-")


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir is not set"):
        _fallback_dir("yarn")
    assert _fallback_dir("local[2]")


def test_cluster_conf():
    c = cluster_conf(4000)
    assert c["spark.sql.shuffle.partitions"] == "16000"
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert "RocksDB" in c["spark.sql.streaming.stateStore.providerClass"]
