from __future__ import annotations

from types import SimpleNamespace

import pytest

from stratalake import storage
from tests.conftest import rows


def fake_session(configured=None, master="yarn"):
    context = SimpleNamespace(
        getConf=lambda: SimpleNamespace(get=lambda key: configured),
        getCheckpointDir=lambda: None,
        master=master,
    )
    return SimpleNamespace(sparkContext=context)


def test_scratch_root_is_the_configured_checkpoint_folder():
    assert storage.scratch_root(fake_session("hdfs:///shared/cp/")) == "hdfs:///shared/cp"


def test_a_cluster_without_checkpoint_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.scratch_root(fake_session())


def test_staged_copy_is_removed_and_written_copy_stays(spark, tmp_path):
    with storage.staged(spark.range(3)) as copy:
        path = copy.inputFiles()[0].rsplit("/", 1)[0]
        assert rows(copy) == [(0,), (1,), (2,)]
        assert path.rsplit("/", 1)[-1] in storage.list_folders(spark, storage.scratch_root(spark))
    assert path.rsplit("/", 1)[-1] not in storage.list_folders(spark, storage.scratch_root(spark))
    assert rows(storage.written_copy(spark.range(2))) == [(0,), (1,)]


def test_staged_copy_is_removed_after_an_error(spark):
    before = storage.list_folders(spark, storage.scratch_root(spark)).keys()
    with pytest.raises(RuntimeError), storage.staged(spark.range(1)):
        raise RuntimeError
    assert storage.list_folders(spark, storage.scratch_root(spark)).keys() == before
