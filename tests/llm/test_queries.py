"""The registered queries: names, SQL counterparts, and the guard of the entry module."""

from __future__ import annotations

import os
import re
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as contract
import pytest
from compare import connect, differences

from trailperks.llm import queries  # noqa: F401
from trailperks.llm.registry import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
ROOT = Path(__file__).parents[2]


def test_one_query_per_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert QUERIES.keys() | {"pipeline"} <= contract.queries().keys() and ORACLES.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, name):
    assert differences(spark, name, QUERIES[name], ORACLES[name], SMALL, connect(SMALL)) == []


def test_the_rest_works_without_this_subpackage(tmp_path):
    """The entry module imports when the pipeline and the subpackage are gone, but hides no other error."""
    for part in ("trailperks", "__spark_entry__.py", "corpus_pipeline.py"):
        (tmp_path / part).symlink_to(ROOT / part)
    count = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries())"

    # Without PYTHONPATH, on which the repository itself may be.
    env = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}

    def run(folder):
        return subprocess.run([sys.executable, "-c", count], cwd=folder, env=env, capture_output=True, text=True, timeout=120)

    assert run(tmp_path).stdout.split()[1] == "True"
    (tmp_path / "corpus_pipeline.py").unlink()
    assert run(tmp_path).stdout.split()[1] == "False"
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module")
    assert "no_such_module" in run(tmp_path).stderr
