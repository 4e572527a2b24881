import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from stintwise.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.01"
SMALL_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "stintwise-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def laps(spark):
    from stintwise.registry.workspace import Workspace

    return Workspace(spark, SMALL_DIR).laps()


def by(df, *keys):
    """Rows of a small result as {key or keys: Row}."""
    return {(r[keys[0]] if len(keys) == 1 else tuple(r[k] for k in keys)): r for r in df.collect()}
