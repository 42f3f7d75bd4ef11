"""Choice of the shared folder."""

from types import SimpleNamespace

import pytest

from ledgerline.session import shared_dir


class Conf(dict):
    def set(self, key, value):
        self[key] = value


def session(master, **conf):
    return SimpleNamespace(conf=Conf(conf), sparkContext=SimpleNamespace(master=master))


def test_the_cluster_setting_wins():
    cluster = session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert shared_dir(cluster) == "hdfs:///shared"


def test_a_cluster_without_the_setting_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("spark://host:7077"))


def test_a_local_session_gets_one_folder_of_its_own():
    local = session("local[2]")
    assert shared_dir(local) == shared_dir(local) != shared_dir(session("local[2]"))
