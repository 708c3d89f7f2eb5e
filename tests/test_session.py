"""Where intermediate data may go."""

import os
import types

import pytest

from loadsmith.session import drop_scratch, ensure_checkpoint_dir, scratch_path


def fake(master, configured=None):
    folder = []
    context = types.SimpleNamespace(master=master, getCheckpointDir=lambda: folder[0] if folder else None,
                                    setCheckpointDir=folder.append)
    return types.SimpleNamespace(sparkContext=context, conf=types.SimpleNamespace(get=lambda k, d: configured or d))


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "k8s://h", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_its_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake(master))
    assert ensure_checkpoint_dir(fake(master, "hdfs://shared")) == "hdfs://shared"


@pytest.mark.parametrize("master", ["local", "local[*]", "local[8]"])
def test_local_mode_may_use_a_folder_of_its_own(master):
    assert os.path.isdir(ensure_checkpoint_dir(fake(master)))


def test_scratch_data_can_be_dropped(spark):
    path = scratch_path(spark, "t")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.isdir(local)
    drop_scratch(spark)
    assert not os.path.exists(local)
