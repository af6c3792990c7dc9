import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tillhouse.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session(
        "tests",
        spark__master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()
