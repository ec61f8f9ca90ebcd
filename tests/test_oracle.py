"""A cross-section of the registered queries against their SQL on the smallest tables."""

import pytest
from oracle import compare, connect

from tidemark.plans import all_queries

SF = "/root/testdata/sf0.001"
NAMES = [
    "q_resample_hourly", "q_dedupe_last", "q_asof_backward_limit", "q_asof_nearest", "q_upsample_ffill", "q_continuity",
    "q_validate_weather", "q_outlier_iqr", "q_impute", "q_lag", "q_ewm", "q_apparent", "q_target_split", "q_hist",
    "q_metrics", "q_walk_forward", "q_ks", "q_degradation", "q_score_map", "q_acf", "q_stream_resample",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    q = all_queries()[name]
    assert compare(q.run(spark, SF).toPandas(), con.execute(q.sql).df()) is None
