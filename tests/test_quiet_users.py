"""q_stream_quiet_users gives starting balances only to keys that can be given."""

from millrace.plans.registry import Tables
from millrace.plans.streams import starting_totals


def test_only_customers_with_events_hold_a_balance(spark, tmp_path):
    customers = [(1, 10.4), (1, 1.0), (2, 20.0), (None, 3.0), (None, 4.0), (7, 2.0)]
    spark.createDataFrame(customers, "c_custkey bigint, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    events = [(1, 1), (2, None), (3, 5), (4, 1)]
    spark.createDataFrame(events, "event_id bigint, user_id bigint").write.parquet(f"{tmp_path}/events.parquet")
    got = sorted(starting_totals(Tables(spark, str(tmp_path))).collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    # customers 2 and 7 have no events; repeated and null keys keep all their rows
    assert [tuple(r) for r in got] == [(None, 3), (None, 4), (1, 1), (1, 10)]
