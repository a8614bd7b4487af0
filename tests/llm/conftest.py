import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import pytest  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """A folder of the session; a cluster names one in spark.checkpoint.dir."""
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
