import uuid

import pytest

from tidemark import session


def test_stored_data_is_whole_and_can_be_cleared(spark):
    df = spark.range(100).repartition(3)
    kept = session.stored(df, "test")
    assert kept.count() == 100
    path = kept.inputFiles()[0].rsplit("/", 1)[0]
    assert session.exists(spark, path)
    made = list(session._made)
    session._made[:] = [p for p in made if p.rsplit("/", 1)[1] == path.rsplit("/", 1)[1]]
    session.clear_scratch(spark)
    session._made[:] = [p for p in made if p.rsplit("/", 1)[1] != path.rsplit("/", 1)[1]]
    assert not session.exists(spark, path)


def test_paths_are_new_and_name_their_file_system(spark):
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a != b and a.startswith("file:")


def test_setting_is_restored(spark):
    key = f"tidemark.test.{uuid.uuid4().hex}"
    with session.setting(spark, key, "1"):
        assert spark.conf.get(key) == "1"
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "0")
    with pytest.raises(RuntimeError), session.setting(spark, key, "1"):
        raise RuntimeError
    assert spark.conf.get(key) == "0"


def test_a_cluster_has_to_name_its_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Cluster:
        conf = Conf()
        sparkContext = type("C", (), {"master": "yarn"})

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.shared_root(Cluster())
