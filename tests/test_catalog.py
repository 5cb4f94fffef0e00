import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import compare, connect


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, connection, sf_dir, name):
    assert compare(spark, connection, sf_dir, queries()[name], oracle_sql()[name]) == ""


def test_entry(spark):
    rows = entry(spark)
    assert rows.count() > 0 and "port_congestion_index" in rows.columns


def test_oracles_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())


def test_approximate_percentile_is_near_the_exact_one(spark, sf_dir):
    exact = queries()["stop_metrics"](spark, sf_dir)
    approx = queries()["stop_p90_approx"](spark, sf_dir).withColumnRenamed("p90_dwell_time_minutes", "sketched")
    keys = ["report_date", "port_id"]
    rows = exact.join(approx.select(*keys, "sketched", "stops").withColumnRenamed("stops", "n"), keys).collect()
    assert len(rows) == exact.count()
    # The sketch returns an observed dwell time, so a lone stop is reported exactly.
    assert all(r.stops == r.n and (r.n > 1 or r.sketched == r.p90_dwell_time_minutes) for r in rows)
