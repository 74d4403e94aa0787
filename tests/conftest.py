import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from paylens.session import get_session
    s = get_session(app="paylens-tests", master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture
def roles(spark):
    """Factory: RoleTables from small row lists (unspecified roles are empty)."""
    from paylens.sources.bindings import ROLES, RoleTables
    from paylens.sources.schemas import ROLE_SCHEMAS

    def make(**rows):
        return RoleTables(**{r: spark.createDataFrame(rows.get(r, []), ROLE_SCHEMAS[r]) for r in ROLES})
    return make


@pytest.fixture
def multi_partition(spark):
    """Keep range exchanges at spark.sql.shuffle.partitions partitions (no AQE
    coalescing), so ranking tests cross partition boundaries."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield spark
    spark.conf.set(key, old)
