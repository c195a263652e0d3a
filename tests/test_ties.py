"""Rows on which a query and its SQL must follow one rule: tied instants, closes of zero, halves."""
import datetime as dt

import duckdb
import pytest

from tests.oracle import compare
from tidemark.plans.catalogue import ORACLES, QUERIES

START = dt.datetime(2024, 1, 2, 9, 0, 0)


def events(spark, tmp_path, rows):
    """Rows of (event_id, seconds after the start, value), and a connection that reads them."""
    path = f"{tmp_path}/events.parquet"
    spark.createDataFrame(
        [(i, START + dt.timedelta(seconds=s), 1, "view", v, f'{{"k": {i % 7}}}') for i, s, v in rows],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    ).write.parquet(path)
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{path}/*.parquet'")
    return con


@pytest.mark.parametrize("name", ["j1_asof_backward", "j3_asof_strict_many", "j4_asof_staleness",
                                  "n1_research_frame"])
def test_highest_id_of_an_instant_is_matched(spark, tmp_path, name):
    # Ids fall and rise within an instant, and every instant holds many.
    rows = [(1 + k * 60 + (37 * n) % 60, 5 * k, 1.0 + (37 * n) % 60) for k in range(60) for n in range(60)]
    con = events(spark, tmp_path, rows)
    df = QUERIES[name](spark, str(tmp_path))
    assert compare(con, df, ORACLES[name]) == ""
    last = {r["trade_ts"]: r["trade_id"] for r in df.where("trade_ts IS NOT NULL").collect()}
    assert all(i == 60 + 60 * ((t - START).seconds // 5) for t, i in last.items())


@pytest.mark.parametrize("name", ["g16_bar_returns", "j7_trailing_window", "j8_lookahead_audit",
                                  "n1_research_frame"])
def test_a_close_of_zero_gives_no_return(spark, tmp_path, name):
    rows = [(1 + k, 60 * k + 3, 0.0 if k in (20, 21, 90) else 10.0 + (k * k) % 17) for k in range(140)]
    con = events(spark, tmp_path, rows)
    assert compare(con, QUERIES[name](spark, str(tmp_path)), ORACLES[name]) == ""


def test_a_return_is_rounded_by_its_digits(spark, tmp_path):
    # 36.49 / 128 - 1 lies just above -0.714921875; times 1e8 it is rounded to the half itself.
    con = events(spark, tmp_path, [(1, 3, 128.0), (2, 63, 36.49)])
    df = QUERIES["g16_bar_returns"](spark, str(tmp_path))
    assert compare(con, df, ORACLES["g16_bar_returns"]) == ""
