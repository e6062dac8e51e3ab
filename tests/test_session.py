import os

import pytest

from reviewlens import session


def test_scratch_is_cleared(spark, monkeypatch):
    monkeypatch.setattr(session, "_SCRATCH", {})
    path = session.scratch_path(spark, "test")
    spark.range(3).write.parquet(path)
    assert os.path.isdir(path.removeprefix("file://").removeprefix("file:"))
    assert session.clear_scratch(spark) == 1 and session.clear_scratch(spark) == 0
    assert not os.path.exists(path.removeprefix("file://").removeprefix("file:"))


def test_a_cluster_needs_a_shared_folder():
    class Context:
        applicationId = "app"

        def getCheckpointDir(self):
            return None

    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        sparkContext = Context()

        def __init__(self, **values):
            self.conf = Conf(values)

    for master in ("yarn", "k8s://x", "spark://x:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            session.shared_dir(Session(**{"spark.master": master}))
    assert session.shared_dir(Session(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://a/b/"})) == "hdfs://a/b"
