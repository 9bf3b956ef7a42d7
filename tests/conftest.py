import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
# A folder holding the shipped payroll files (payroll_data/*.csv and
# raw/EmpMaster.csv, raw/AgencyMaster.csv); the checks against their known
# numbers are skipped when it is not given.
REF_DATA = os.environ.get("STARMART_PAYROLL_DATA", "")


@pytest.fixture(scope="session")
def spark():
    from starmart.session import local_session
    s = local_session(cpus="*", shuffle_partitions=8, app="starmart-tests", memory="8g")
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    """A fresh folder below the session's checkpoint root."""
    from starmart.session import scratch_path
    return scratch_path(spark, "test")
