from types import SimpleNamespace

import pytest

from starloom.plans.scratch import shared_folder


def _session(master, **conf):
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="app-1"))


def test_the_folder_the_session_names_is_used():
    assert shared_folder(_session("yarn", **{"spark.checkpoint.dir": "hdfs:///tmp/"})) == "hdfs:///tmp/starloom-app-1"


def test_a_cluster_must_name_one():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_session("yarn"))


def test_a_local_session_may_do_without():
    assert "starloom-" in shared_folder(_session("local[2]"))
