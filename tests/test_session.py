"""Session settings and where scratch data goes."""

from types import SimpleNamespace

import pytest

from railgauge.session import pin_utc, scratch_dir


def fake(master, folder):
    conf = SimpleNamespace(get=lambda key, default=None: folder)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(f"{shared}/x-") and first != second
    assert scratch_dir(fake("yarn", "hdfs:///shared/"), "x").startswith("hdfs:///shared/x-")


def test_a_cluster_must_name_its_folder():
    assert "railgauge-" in scratch_dir(fake("local[2]", None), "x")
    with pytest.raises(RuntimeError):
        scratch_dir(fake("yarn", None), "x")


def test_times_are_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    pin_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
