"""Every registered query equals its SQL counterpart on whole tables."""

import compare
import pytest

import __spark_entry__ as entry
from tunelab.plans.catalog import QUERIES
from tunelab.plans.oracle import ORACLE

SMOKE = "/root/testdata/sf0.001"
CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return {sf_dir: compare.connect(sf_dir) for sf_dir in (SMOKE, CHECK)}


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    rows = {row["class"]: row for row in entry.entry(spark).collect()}
    assert set(rows) == {"Dismissal (0)", "Approval (1)", "micro avg", "macro avg", "weighted avg"}


@pytest.mark.parametrize("sf_dir", [SMOKE, CHECK])
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name, sf_dir):
    ours = entry.queries()[name](spark, sf_dir)
    assert compare.differences(ours, con[sf_dir].sql(entry.oracle_sql()[name])) is None
