from __future__ import annotations

import io
import sys
from contextlib import redirect_stdout
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from palisade.session import local_session  # noqa: E402
from verification.derived import bronze_from_events  # noqa: E402

SMALL = "/root/testdata/sf0.001"
NOW = "2026-12-01 00:00:00"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def bronze(spark):
    return bronze_from_events(spark, SMALL)


@pytest.fixture
def plan():
    """The text of the plan a DataFrame would run with."""

    def text(df) -> str:
        shown = io.StringIO()
        with redirect_stdout(shown):
            df.explain("formatted")
        return shown.getvalue()

    return text
