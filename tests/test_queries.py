"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

import __spark_entry__ as entry
import check
from ledgerline.schemas import ANALYTICS_VIEW
from ledgerline.workload.oracle import ORACLE
from ledgerline.workload.queries import QUERIES


@pytest.fixture(scope="module")
def twin(sf_dir):
    return check.connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert len(QUERIES) == 70


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, sf_dir, twin, name):
    assert check.compare(spark, twin, sf_dir, name) == []


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ANALYTICS_VIEW
    assert df.count() > 0
