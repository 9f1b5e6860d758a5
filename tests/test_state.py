import datetime as dt

from millrace.streaming.sinks import append_files, finish
from millrace.streaming.state import quiet_totals, state_session

SCHEMA = "user_id bigint, amount bigint, ts timestamp"


def at(minute):
    return dt.datetime(2024, 1, 1, tzinfo=dt.UTC) + dt.timedelta(minutes=minute)


def test_quiet_keys_are_given_once_across_restarts(spark, tmp_path):
    own = state_session(spark)
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass", "")
    first = own.createDataFrame([(1, 100), (9, 5)], "user_id bigint, total bigint")

    def run(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = own.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in").withWatermark("ts", "0 seconds")
        out = quiet_totals(stream, "user_id", "amount", "ts", 600_000, first)
        finish(append_files(out, f"{tmp_path}/out", f"{tmp_path}/state"))
        return sorted(tuple(r)[:3] for r in spark.read.schema("user_id bigint, n bigint, total bigint").parquet(f"{tmp_path}/out").collect())

    # user 1 begins with 100 and is quiet from minute 1 on; user 2 is not yet
    assert run([(1, 7, at(0)), (1, 1, at(1)), (2, 3, at(20))]) == [(1, 2, 108)]
    # after the restart the totals of user 2 go on, and its timer moves with its last row
    assert run([(2, 4, at(25)), (3, 1, at(31))]) == [(1, 2, 108)]
    # user 1 comes again and begins at zero
    assert run([(1, 5, at(32)), (4, 1, at(50))]) == sorted([(1, 2, 108), (2, 2, 7), (3, 1, 1), (1, 1, 5)])
