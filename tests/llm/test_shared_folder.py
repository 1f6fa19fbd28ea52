"""Where intermediate tables go."""

from types import SimpleNamespace

import pytest

from gondola.llm import common


def session(master, path):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: path, setCheckpointDir=lambda p: None)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))


def test_a_cluster_needs_a_shared_folder():
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            common.shared_dir(session(master, None))
        assert common.shared_dir(session(master, "hdfs://x/y/")) == "hdfs://x/y"
