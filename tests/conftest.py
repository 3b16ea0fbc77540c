import sys
import tempfile
import time
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stockyard.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    root = tempfile.mkdtemp(prefix="run-")
    conf = {
        "spark.sql.warehouse.dir": f"{root}/warehouse",
        "spark.checkpoint.dir": f"{root}/scratch",
        "spark.driver.memory": "4g",
    }
    session = local_session("tests", 4, **conf)
    yield session
    session.stop()


@pytest.fixture
def shuffle_files(spark):
    """The files that shuffles have left; with `gone`, waits a while until there are none but these."""

    def found(gone=None):
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        for _ in range(50):
            files = manager.getAllFiles()
            names = {files.apply(i).getName() for i in range(files.size())}
            names = {n for n in names if n.startswith("shuffle_")}
            if gone is None or names <= gone:
                break
            time.sleep(0.1)
        return names

    return found


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")
