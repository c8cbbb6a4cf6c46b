from types import SimpleNamespace

import pytest

from sondaflow import session
from sondaflow.session import scale_settings, scratch_path, shared_folder, sized


def _session(master, conf=None, checkpoint=None):
    values = dict(conf or {})
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda k, d=None: values.get(k, d), set=values.__setitem__),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint))


def test_the_cluster_names_the_folder():
    assert shared_folder(_session("spark://m:7077", {"spark.checkpoint.dir": "hdfs://n/c/"})) == "hdfs://n/c"
    assert shared_folder(_session("yarn", checkpoint="hdfs://n/d")) == "hdfs://n/d"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_session("spark://m:7077"))


def test_a_local_session_makes_one_folder_and_keeps_it(tmp_path, monkeypatch):
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    session = _session("local[2]")
    folder = shared_folder(session)
    assert folder == shared_folder(session) and folder.startswith(str(tmp_path))
    assert scratch_path(session, "a") != scratch_path(session, "a")


@pytest.mark.parametrize("shuffled, cores, partitions", [
    (0, 8, 16), (10 << 30, 4, 20), (1 << 40, 1000, 2048), (100 << 40, 4000, 204_800)])
def test_partitions_follow_the_data(shuffled, cores, partitions):
    assert scale_settings(shuffled, cores)["spark.sql.shuffle.partitions"] == str(partitions)


def test_a_bound_on_partitions_is_told():
    with pytest.warns(UserWarning, match="204800 partitions"):
        settings = scale_settings(100 << 40, 4000, most_partitions=100_000)
    assert settings["spark.sql.shuffle.partitions"] == "100000"


def test_a_session_is_sized_in_place():
    session = _session("local[2]")
    session.sparkContext.defaultParallelism = 8
    assert sized(session, 10 << 30).conf.get("spark.sql.shuffle.partitions") == "20"
    assert sized(session, 0, 50).conf.get("spark.sql.shuffle.partitions") == "100"


def test_small_parts_bound_the_input_of_a_task(spark):
    key, other = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before, other_before = spark.conf.get(key), spark.conf.get(other)
    try:
        spark.conf.set(other, "1m")
        with session.small_parts(spark):
            with session.small_parts(spark):
                assert int(spark.conf.get(key)) == session.MOST_BYTES[key]
            assert int(spark.conf.get(key)) == session.MOST_BYTES[key]
            assert spark.conf.get(other) == "1m"
        assert spark.conf.get(key) == before
    finally:
        spark.conf.set(other, other_before)
