import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cuebreaks import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "cuebreaks-tests",
        "local[*]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="6g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
