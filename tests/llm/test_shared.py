from types import SimpleNamespace

import pytest

from epochloom.llm import shared


def session(master, folder=None):
    conf = SimpleNamespace(get=lambda key: folder)
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, getConf=lambda: conf)
    return SimpleNamespace(sparkContext=context)


def test_a_cluster_without_a_shared_folder_is_refused():
    for master in ("spark://a:7077", "yarn", "k8s://x", "local-cluster[3,2,1000]"):
        with pytest.raises(RuntimeError):
            shared.shared_folder(session(master))
        assert shared.shared_folder(session(master, "hdfs://a/b/")).startswith("hdfs://a/b/")
    for master in ("local", "local[4]", "local[*]", "local[4,2]"):
        assert "shared-" in shared.shared_folder(session(master))
