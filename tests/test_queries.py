"""Registered queries against DuckDB. Every query with TIDEMARK_ALL=1, a cross-section otherwise."""
import os

import pytest

from tests.oracle import compare, connect
from tidemark.plans.catalogue import ORACLES, QUERIES

SF = os.environ.get("TIDEMARK_SF", "/root/testdata/sf0.001")
SAMPLE = """a1_ohlcv_bars_range a3_bar_rollup j1_asof_backward j2_asof_many_keys j2_asof_broadcast
 j3_asof_strict j3_asof_strict_many j7_trailing_window v11_first_reason v12_dedup_first_arrival
 v15_failure_rollup q3_monotonic_trade_id q9b_short_days c9_in_session g6_ratio_adjusted
 g9_unadjustable_rolls r1_map_refresh j11_valid_as_of m6_rsi k13_arrival_status k14_arrival_gaps
 l4_warn_rate_rising e1_entitlement_decisions w3_keyed_insert r4_run_source k5_stream_replay_dedup
 k6_stream_bars k7_late_and_future_rows""".split()
NAMES = sorted(ORACLES) if os.environ.get("TIDEMARK_ALL") else SAMPLE


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, name):
    assert compare(con, QUERIES[name](spark, SF), ORACLES[name]) == ""


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
