from __future__ import annotations

import os

import pytest

from millwatt import session


class Named:
    """A session as far as ``work_folder`` asks it."""

    def __init__(self, **conf):
        self.conf = self
        self.values = conf

    def get(self, key, default=None):
        return self.values.get(key.replace(".", "_"), default)


def test_folders_lie_in_the_shared_one(spark):
    folder = session.work_folder(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir") + "/x-")
    spark.range(3).write.parquet(folder)
    session.release(spark)
    assert not os.path.exists(folder)


def test_a_cluster_must_name_its_shared_folder():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]", ""):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.work_folder(Named(spark_master=master), "x")
    assert session.work_folder(Named(spark_master="local[4]"), "x")
