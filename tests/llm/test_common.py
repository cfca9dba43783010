"""Shared tables: where they go, and when they are deleted."""

from types import SimpleNamespace

import pytest

from furrow.llm.common import materialise, tidy
from furrow.session import fresh_path, shared_dir


def session(master, folder=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=SimpleNamespace(master=master, applicationId="app-1"))


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError):
        shared_dir(session("spark://host:7077"))
    assert shared_dir(session("spark://host:7077", "hdfs://x/y/")) == "hdfs://x/y"
    assert fresh_path(session("local[2]", "/s"), "t").startswith("/s/furrow-app-1/t-")
    assert shared_dir(session("local[2]")) == shared_dir(session("local[2]"))


def test_tables_of_a_block_are_deleted(spark):
    with tidy() as kept:
        gone, stays = (materialise(spark.range(3), n) for n in ("gone", "stays"))
        kept.append(stays)
    assert stays.count() == 3
    path = spark._jvm.org.apache.hadoop.fs.Path(gone._furrow_path)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
