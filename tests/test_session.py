"""Where the library writes between steps."""

from types import SimpleNamespace

import pytest

from pitwall.session import shared_root


def session(master, warehouse, folder=None):
    conf = {"spark.sql.warehouse.dir": warehouse} | ({"spark.checkpoint.dir": folder} if folder else {})
    get = lambda key, default=None: conf.get(key, default)
    return SimpleNamespace(conf=SimpleNamespace(get=get), sparkContext=SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=get)))


def test_shared_folder():
    assert shared_root(session("yarn", "file:/w", "hdfs://n/c/")) == "hdfs://n/c"
    assert shared_root(session("spark://h:1", "s3a://b/w")) == "s3a://b/w/_work"
    assert shared_root(session("local[8]", "file:/w/")) == "file:/w/_work" and shared_root(session("local", "/w")) == "/w/_work"
    for warehouse in ("file:/w", "/w", "w"):
        with pytest.raises(ValueError):
            shared_root(session("local-cluster[2,1,1000]", warehouse))
