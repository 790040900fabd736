import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from spoolway.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {"spark.ui.enabled": "false", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    spark = session("local[4]", 4, **conf)
    spark.sparkContext.setLogLevel("OFF")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
