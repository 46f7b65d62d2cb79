from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from loomspan.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return build_session("local[4]", 4, **{"spark.driver.memory": "3g", "spark.ui.showConsoleProgress": "false"})


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(DATA).exists():
        pytest.skip("no test tables here")
    return DATA


@pytest.fixture(autouse=True)
def freed():
    """Tables of a test's operators go when it ends."""
    from loomspan.scratch import free, mark

    at = mark()
    yield
    free(at)


@pytest.fixture()
def scratch(spark):
    from loomspan.scratch import Scratch

    return Scratch(spark, "test")
