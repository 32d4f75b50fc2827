"""Every registered query next to its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
import check
from tallyvein.plans import QUERIES

SLOW_ROWS_ONLY = {"predict_ratings", "factor_scores", "bfr_labels", "girvan_newman"}  # covered by their own tests


@pytest.fixture(scope="module")
def db(data):
    return check.connect(data)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW_ROWS_ONLY])
def test_query(spark, db, data, name):
    problem, _ = check.compare(spark, db, name, data)
    assert problem is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["src", "dst", "cnt"]
    assert df.count() > 0


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
