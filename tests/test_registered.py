"""Every registered query against its SQL, on whole tables."""

import os

import pytest
from conftest import SF

from checks.catalog import all_checks
from checks.compare import connect, difference

CHECKS = all_checks()
# The long plans contain the shorter ones, so these stand for all of them unless asked otherwise.
LONG = {"professional_source", "patient_source", "marketing_activity", "activity_with_bounce_flags",
        "email_engagement_base", "interactions", "net_bounce"}
NAMES = [n for n in CHECKS if n not in LONG or os.environ.get("TEST_ALL")]


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, duck, name):
    rows, note = difference(spark, duck, CHECKS[name], SF)
    assert note is None
    assert rows > 0


def test_contract_functions_agree():
    import __spark_entry__ as contract

    assert set(CHECKS) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
