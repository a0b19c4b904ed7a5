from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from hearthspark.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, memory="8g", name="tests")


@pytest.fixture(scope="session")
def survey(spark):
    from hearthspark.sources.survey import Survey

    return Survey(spark, SMALL)
