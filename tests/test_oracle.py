"""A quick part of the SQL comparison; ``tests.check_oracle`` runs all of it."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.check_oracle import connect, difference

FOLDER = "/root/testdata/sf0.001"
QUICK = (
    "account_window_features",
    "validate_events",
    "dead_letter_envelope", "routed_values",
    "merchant_category_risk",
    "ks_drift",
    "rolling_velocity",
    "device_activity",
    "quality_report",
    "upsert_transactions",
)


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, database, name):
    ours = queries()[name](spark, FOLDER).toArrow()
    assert difference(ours, database.execute(oracle_sql()[name]).to_arrow_table()) is None


def test_every_sql_has_a_query(spark):
    assert set(oracle_sql()) <= set(queries())
    assert entry(spark).limit(1).count() == 1
