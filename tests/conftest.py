import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkdeck.session import scratch, session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}",
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def own_tables(request):
    """Each test deletes the intermediate tables it wrote."""
    if "spark" not in request.fixturenames:
        yield
        return
    with scratch(request.getfixturevalue("spark")):
        yield


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("SF_DIR", "/root/testdata/sf0.001")
