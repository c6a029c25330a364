import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parley import runtime


@pytest.fixture(scope="session")
def spark():
    session = runtime.session("tests", spark__master="local[4]", spark__sql__shuffle__partitions="2", spark__driver__memory="8g")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
