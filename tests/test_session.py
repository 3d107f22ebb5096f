"""Session helpers: large-scale settings and the shared checkpoint folder."""

from tarmac.session import checkpoint_dir, large_scale_settings


def test_large_scale_settings_scale_with_input():
    small = large_scale_settings(10 * 1024**3)
    big = large_scale_settings(100 * 1024**4)
    assert int(small["spark.sql.shuffle.partitions"]) == 200  # floor
    # 100 TB, 15% of it shuffled, 128 MB per partition
    assert int(big["spark.sql.shuffle.partitions"]) == 122_880
    assert big["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"


def test_checkpoint_dir_is_taken_from_the_session(spark):
    first = checkpoint_dir(spark)
    assert first and checkpoint_dir(spark) == first  # set once, then reused
    assert spark.sparkContext.getCheckpointDir() == first


def test_checkpoint_dir_never_falls_back_to_a_local_folder_on_a_cluster():
    import pytest

    class _Conf:
        def get(self, key, default=None):
            return default

    class _Context:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return _Conf()

    class _Session:
        sparkContext = _Context()
        conf = _Conf()

    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session())
