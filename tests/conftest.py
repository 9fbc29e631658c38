import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from kpiloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("kpiloom-tests", "local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def text_file(tmp_path):
    def write(name: str, content, folder=None) -> str:
        path = (folder or tmp_path) / name
        path.write_bytes(content if isinstance(content, bytes) else content.encode())
        return str(path)

    return write
