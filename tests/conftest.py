import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rankloom.session import spark_session


@pytest.fixture(scope="session")
def spark():
    session = spark_session(
        "tests", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled=False,
        spark__driver__memory="8g", spark__ui__showConsoleProgress=False,
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
