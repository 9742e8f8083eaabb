"""One local session for all tests, with its own folders."""

import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")

DATA = Path(os.environ.get("TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    from corvane.session import build_session

    folder = tempfile.mkdtemp(prefix="spark-")
    session = build_session(
        "local[8]", "tests",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g", "spark.local.dir": folder,
            "spark.checkpoint.dir": f"file://{folder}/checkpoints", "spark.sql.warehouse.dir": f"{folder}/warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    folder = DATA / "sf0.001"
    if not folder.exists():
        pytest.skip("the given tables are absent")
    return str(folder)
