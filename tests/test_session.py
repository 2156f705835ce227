from types import SimpleNamespace

import pytest

from eventlake.session import checkpoint_dir


def stub(master, configured=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda path: None)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: configured))


def test_a_cluster_without_a_shared_folder_is_refused():
    for master in ("yarn", "spark://host:7077", "k8s://host"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_dir(stub(master))
    assert checkpoint_dir(stub("yarn", "hdfs:///shared")) == "hdfs:///shared"
