from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabkit.session import build_session  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8, 8, log_level="ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder() -> str:
    return FOLDER


def plan_of(df) -> str:
    """The physical plan as text, as ``explain("formatted")`` prints it."""
    import contextlib
    import io

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
