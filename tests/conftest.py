from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from compare import SMALL  # noqa: E402
from trailperks.session import local_session  # noqa: E402
from trailperks.sources.layers import Layers  # noqa: E402
from trailperks.sources.testdata import TestTables  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(8, memory="6g", **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture()
def layers(spark, tmp_path):
    return Layers(spark, str(tmp_path / "layers"))


@pytest.fixture()
def tables(spark):
    return TestTables(spark, SMALL)
