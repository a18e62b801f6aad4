"""Every registered query against its DuckDB oracle on sf0.001 (the driver uses sf0.01)."""

import pytest

from scripts.oracle_check import compare, duck
from tests.conftest import SF_SMALL
from thermoflux.plans import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert name in ORACLE_SQL
    ok, msg = compare(spark, con, SF_SMALL, name)
    assert ok, msg


def test_entry_runs(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(QUERIES) == set(ORACLE_SQL) <= set(e.oracle_sql()) <= set(e.queries())


def test_rolling_ops_one_row_per_input(spark):
    for name in ("rolling_sum", "rolling_max"):
        df = QUERIES[name](spark, SF_SMALL)
        assert df.count() == 1000 == df.select("event_id").distinct().count()


def test_early_firing_counts_never_decrease(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = QUERIES["early_firing_count"](spark, SF_SMALL)
    w = Window.partitionBy("id", "window_end").orderBy("eval_time", "cnt")
    bad = df.withColumn("prev", F.lag("cnt").over(w)).filter(F.col("prev") > F.col("cnt"))
    assert bad.count() == 0
