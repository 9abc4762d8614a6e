from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratalake.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", partitions=4)
    yield session
    session.stop()


@pytest.fixture
def write_lines(tmp_path):
    """Write text files below a temporary folder: ``write_lines({"a/b.json": [lines]})``."""

    def write(files: dict[str, list[str]]) -> str:
        for name, lines in files.items():
            path = tmp_path / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text("\n".join(lines) + "\n")
        return str(tmp_path)

    return write


def rows(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]
