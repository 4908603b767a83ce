from __future__ import annotations

import pytest

import __spark_entry__ as entry
from plinth.plans.queries import ENTRIES

from .conftest import DATA
from .oracle import duck, same

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", [n for n, e in ENTRIES.items() if e.sql])
def test_against_oracle(spark, con, name):
    same(spark, con, entry.queries()[name], ENTRIES[name].sql, SF)


@pytest.mark.parametrize("name", [n for n, e in ENTRIES.items() if not e.sql])
def test_runs(spark, name):
    rows = entry.queries()[name](spark, SF).collect()
    assert rows and all(any(v is not None for v in r[1:]) for r in rows)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_id_is_stated():
    assert all(e.ids for e in ENTRIES.values())
