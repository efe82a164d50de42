"""The scratch folder."""

import pytest

from clickloom import session


class Cluster:
    """A session of a cluster, as far as the scratch folder is concerned."""

    class sparkContext:
        master = "spark://host:7077"
        applicationId = "app"

        @staticmethod
        def getConf():
            return {}

        class _jsc:
            @staticmethod
            def sc():
                return Cluster.sparkContext._jsc

            @staticmethod
            def getCheckpointDir():
                return Cluster.sparkContext._jsc

            @staticmethod
            def isDefined():
                return False

    def __init__(self, **conf):
        self.conf = conf


@pytest.mark.parametrize("warehouse", ["file:/tmp/run/spark-warehouse", "/tmp/run/spark-warehouse"])
def test_a_cluster_without_a_shared_folder_is_refused(warehouse):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(Cluster(**{"spark.sql.warehouse.dir": warehouse}))


def test_shared_folders_are_taken():
    assert session.scratch_root(Cluster(**{"spark.sql.warehouse.dir": "hdfs://lake/warehouse/"})) == "hdfs://lake/warehouse"
    assert session.scratch_root(Cluster(**{"spark.checkpoint.dir": "s3a://lake/shared"})) == "s3a://lake/shared"
