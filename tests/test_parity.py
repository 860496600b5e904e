"""Every registered sales query against its reference SQL, in names, types and all values, on the smallest tables."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest
from parity import connect, difference

import __spark_entry__ as contract
from salescube.catalog.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason=f"no test tables at {SF_DIR}")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, db, name):
    assert difference(spark, db, SF_DIR, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("left", ["nothing", "an empty folder", "a module that lacks its own imports"])
def test_contract_without_the_training_part(tmp_path, left):
    """The sales queries stay when the training part is removed, in whole or in part."""
    root = os.path.dirname(os.path.abspath(contract.__file__))
    shutil.copytree(os.path.join(root, "salescube"), tmp_path / "salescube", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    if left != "nothing":
        (tmp_path / "salescube" / "llm").mkdir()
    if left.startswith("a module"):
        (tmp_path / "corpus_pipeline.py").write_text("import zstandard_that_is_not_there")
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert said.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))], said.stderr


def test_flagship(spark):
    assert contract.entry(spark).count() > 0
