"""Every branch of the queries on rare cases is hit by the tables: a right answer without rows proves nothing."""

import pytest

import __spark_entry__ as entry
from tools.oracle_check import duck

BRANCHES = {
    "sql_hourly_tips_having": ["TRUE"],
    "popular_places_sql": ["is_start", "NOT is_start"],
    "late_side_output": ["TRUE"],
    "punctuated_late_split": ["late", "NOT late"],
    "punctuated_split_stream": ["late", "NOT late"],
    "hourly_tips_slow_rules": ["kind = 'fare'", "kind = 'rule'"],
    "whole_window_rise": ["longest_rise = 1", "longest_rise > 2"],
    "late_window_counts": ["late_cnt > 0 AND cnt > 0", "late_cnt = 0"],
    "late_updates": ["mark = 'first'", "mark = 'update'"],
    "late_updates_stream": ["mark = 'first'", "mark = 'update'", "mark = 'dropped'"],
    "asof_enrich_late": ["late", "NOT late", "customer_info IS NULL"],
    "asof_enrich_revise": ["revision = 0", "revision = 1"],
    "lookup_enrich": ["room = 'UNKNOWN ROOM'", "room <> 'UNKNOWN ROOM'"],
    "arrival_enrich_retry": ["answered = 'at once'", "answered = 'waited' AND customer_info IS NOT NULL", "customer_info IS NULL"],
    "adhoc_rule_table": ["asked = 'row'", "asked = 'rule'"],
}
DROPS = {"car_event_sort": "events", "instance_sessions": "events"}


@pytest.fixture(scope="module")
def con():
    return duck("/root/testdata/sf0.01")


@pytest.mark.parametrize("key", sorted(BRANCHES))
def test_branch_has_rows(con, key):
    for branch in BRANCHES[key]:
        n = con.execute(f"SELECT count(*) FROM ({entry.oracle_sql()[key]}) WHERE {branch}").fetchone()[0]
        assert n > 0, branch


@pytest.mark.parametrize("key", sorted(DROPS))
def test_some_rows_are_dropped(con, key):
    kept = con.execute(f"SELECT count(*) FROM ({entry.oracle_sql()[key]})").fetchone()[0]
    every = con.execute(f"SELECT count(*) FROM {DROPS[key]}").fetchone()[0]
    assert 0 < kept < every
