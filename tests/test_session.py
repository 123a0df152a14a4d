from types import SimpleNamespace

import pytest

import os

from corpuslens.session import ensure_folder, materialise, release, shared_dir, use_folder


def session(master, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}")
    )


def test_configured_folder_wins():
    assert shared_dir(session("spark://host", "hdfs:///shared/")) == "hdfs:///shared"


def test_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("spark://host"))


def test_entry_points_name_a_folder_on_a_local_master_only():
    local = session("local[2]")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(local)
    ensure_folder(local)
    assert os.path.isdir(shared_dir(local)) and shared_dir(local) == shared_dir(local)
    for master in ("local-cluster[2,1,1024]", "yarn"):
        ensure_folder(session(master))
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(session(master))


def test_named_folder():
    other = session("yarn-named")
    use_folder(other, "hdfs:///other/")
    assert shared_dir(other) == "hdfs:///other"


def test_materialise(spark):
    df = materialise(spark.range(5), "numbers")
    assert sorted(r.id for r in df.collect()) == list(range(5)) and df.dtypes == [("id", "bigint")]


def test_release_deletes_what_was_written(spark, monkeypatch):
    monkeypatch.setattr("corpuslens.session._written", {})
    (path,) = {f.rsplit("/", 1)[0] for f in materialise(spark.range(3), "short-lived").inputFiles()}
    place = path.removeprefix("file://").removeprefix("file:")
    assert os.path.isdir(place)
    release(spark)
    assert not os.path.exists(place)
