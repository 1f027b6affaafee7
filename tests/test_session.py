import pytest

from callscope import session


def test_cluster_settings():
    small = session.cluster_settings(10**9, 4000)
    large = session.cluster_settings(60 * 10**12, 4000)
    assert small["spark.sql.shuffle.partitions"] == "8000"
    assert large["spark.sql.shuffle.partitions"] == "286103"


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = session.shared_folder(spark, "x"), session.shared_folder(spark, "x")
    assert first != second
    if base:
        assert first.startswith(base.rstrip("/") + "/x-")


def test_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default):
            return default

    class Spark:
        conf = Conf()

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Spark(), "x")
