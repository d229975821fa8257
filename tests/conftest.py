import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from massloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("tests", "local[4]", spark__sql__shuffle__partitions=4, spark__driver__memory="6g", spark__checkpoint__dir=tmp_path_factory.mktemp("checkpoints"))
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()
