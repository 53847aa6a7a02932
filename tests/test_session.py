from __future__ import annotations

import pytest

from runlens.session import scratch_path


class FakeSession:
    """The two things looked at; `spark.checkpoint.dir` is fixed once Spark runs."""

    def __init__(self, master: str, conf: dict):
        self.sparkContext = type("Context", (), {"master": master})()
        self.conf = conf


def test_scratch_folder_is_the_shared_one():
    session = FakeSession("yarn", {"spark.checkpoint.dir": "hdfs:/shared/folder/"})
    first, second = scratch_path(session, "x"), scratch_path(session, "x")
    assert first.startswith("hdfs:/shared/folder/runlens-x-") and first != second


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(FakeSession("yarn", {}), "x")


def test_local_folder_on_a_single_machine():
    assert scratch_path(FakeSession("local[4]", {}), "x").startswith("file:/")
