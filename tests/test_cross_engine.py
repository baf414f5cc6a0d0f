"""Every query against its SQL twin on the small benchmark tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

SF_DIR = "/root/testdata/sf0.001"
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

if not Path(SF_DIR).is_dir():
    pytest.skip("benchmark tables not present", allow_module_level=True)

import __spark_entry__ as contract  # noqa: E402
from check_oracles import connect, difference  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, con, name):
    n, note = difference(spark, con, name, SF_DIR)
    assert not note and n >= 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
