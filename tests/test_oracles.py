"""Every query with an SQL twin gives the twin's result."""

import pytest
from compare import difference, duck
from conftest import SMALL

import __spark_entry__ as entry

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, con, name):
    got = entry.queries()[name](spark, SMALL).toPandas()
    assert difference(got, con.execute(ORACLES[name]).df()) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_flagship_plan_reads_only_needed_columns(spark):
    plan = entry.entry(spark)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "l_tax" not in plan.split("ReadSchema", 1)[1]
    assert "PushedFilters" in plan
