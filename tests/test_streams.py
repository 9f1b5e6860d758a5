"""Streams of several batches: same rows as the batch form, late rows, retried batches."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.streaming import operators as so
from millrace.streaming.learning import CentroidModel, GradientModel, nearest
from millrace.streaming.sinks import append_files, append_table, batch_folders, finish, latest_updates
from millrace.streaming.sources import event_time, file_stream, fixed_records

SCHEMA = "user STRING, ts TIMESTAMP, value DOUBLE"
START = datetime(2024, 1, 1)


def drop(folder, number, rows):
    """One file of the stream; its time says its turn."""
    folder.mkdir(exist_ok=True)
    path = folder / f"{number:03d}.json"
    path.write_text("\n".join(json.dumps({"user": u, "ts": (START + timedelta(minutes=m)).isoformat(), "value": v}) for u, m, v in rows))
    import os

    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


@pytest.fixture()
def files(tmp_path):
    folder = tmp_path / "in"
    drop(folder, 1, [("a", 0, 1.0), ("b", 5, 2.0), ("a", 50, 3.0)])
    drop(folder, 2, [("a", 130, 4.0), ("b", 125, 5.0)])
    drop(folder, 3, [("b", 131, 0.5)])
    # the first row comes too late: the mark of two batches before is past its hour
    drop(folder, 4, [("a", 10, 100.0), ("b", 300, 6.0)])
    drop(folder, 5, [("z", 1000, 0.0)])
    return folder


def stream(spark, files, one=True):
    return file_stream(spark, str(files), SCHEMA, "json", files_per_batch=1 if one else None)


def test_late_rows_are_left_out(spark, files, tmp_path):
    timed = event_time(stream(spark, files), "ts", "30 minutes")
    counts = so.windowed(timed, "ts", [], [F.count("*").alias("n"), F.sum("value").alias("v")], "1 hour")
    finish(append_files(counts, f"{tmp_path}/out", f"{tmp_path}/state"))
    got = {(r.start - START).seconds // 3600: (r.n, r.v) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {0: (3, 6.0), 2: (3, 9.5), 5: (1, 6.0)}


def test_running_state_over_batches(spark, files, tmp_path):
    totals = so.running_totals(stream(spark, files), "user", "value")
    finish(batch_folders(totals, f"{tmp_path}/out", f"{tmp_path}/state"))
    got = {r.user: (r.n, r.total) for r in latest_updates(spark, f"{tmp_path}/out", ["user"]).collect()}
    assert got == {"a": (4, 108.0), "b": (4, 13.5), "z": (1, 0.0)}


def test_restart_goes_on_where_it_stopped(spark, files, tmp_path):
    for extra in (None, [("a", 1001, 1.0)]):
        if extra:
            drop(files, 6, extra)
        finish(batch_folders(so.running_totals(stream(spark, files), "user", "value"), f"{tmp_path}/out", f"{tmp_path}/state"))
    got = {r.user: r.n for r in latest_updates(spark, f"{tmp_path}/out", ["user"]).collect()}
    assert got == {"a": 5, "b": 4, "z": 1}


def test_sessions_equal_batch(spark, files, tmp_path):
    timed = event_time(stream(spark, files, one=False), "ts", "30 minutes")
    found = so.sessions(timed, "ts", ["user"], [F.count("*").alias("n")], "1 hour")
    finish(append_files(found, f"{tmp_path}/out", f"{tmp_path}/state"))
    batch = so.sessions(spark.read.schema(SCHEMA).json(str(files)), "ts", ["user"], [F.count("*").alias("n")], "1 hour")
    want = {(r.user, r.start, r.n) for r in batch.where("user <> 'z'").collect()}
    assert {(r.user, r.start, r.n) for r in spark.read.parquet(f"{tmp_path}/out").collect()} == want


def test_dedup(spark, files, tmp_path):
    drop(files, 7, [("a", 1000, 1.0), ("z", 1001, 1.0)])
    found = so.first_seen(event_time(stream(spark, files), "ts", "400 days"), ["user"])
    finish(append_files(found.select("user"), f"{tmp_path}/out", f"{tmp_path}/state"))
    assert sorted(r.user for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a", "b", "z"]


def test_left_outer_stream_join(spark, tmp_path):
    drop(tmp_path / "l", 1, [("a", 0, 1.0), ("b", 0, 2.0)])
    drop(tmp_path / "r", 1, [("a", 20, 9.0)])
    for side in "lr":
        drop(tmp_path / side, 2, [("z", 2000, 0.0)])
        drop(tmp_path / side, 3, [("z", 4000, 0.0)])
    left = event_time(stream(spark, tmp_path / "l"), "ts", "10 minutes")
    right = event_time(stream(spark, tmp_path / "r"), "ts", "10 minutes").select(
        F.col("user").alias("user_right"), F.col("ts").alias("at"), F.col("value").alias("other"))
    joined = so.within(left, right, ["user"], "ts", "at", "1 HOUR", "leftOuter").select("user", "value", "other")
    finish(append_files(joined, f"{tmp_path}/out", f"{tmp_path}/state"))
    got = {(r.user, r.other) for r in spark.read.parquet(f"{tmp_path}/out").where("user <> 'z'").collect()}
    assert got == {("a", 9.0), ("b", None)}


def test_table_sink_and_source(spark, files, tmp_path):
    spark.sql("DROP TABLE IF EXISTS stream_sink")
    spark.sql(f"CREATE TABLE stream_sink (user STRING, value DOUBLE) USING parquet LOCATION '{tmp_path}/table'")
    finish(append_table(stream(spark, files).select("user", "value"), "stream_sink", f"{tmp_path}/state"))
    assert spark.table("stream_sink").count() == 9
    again = spark.readStream.table("stream_sink").groupBy("user").agg(F.count("*").alias("n"))
    finish(batch_folders(again, f"{tmp_path}/out", f"{tmp_path}/state2", "complete"))
    assert {r.user: r.n for r in latest_updates(spark, f"{tmp_path}/out", ["user"]).collect()} == {"a": 4, "b": 4, "z": 1}
    spark.sql("DROP TABLE stream_sink")


@pytest.mark.parametrize("kind", ["csv", "orc", "parquet", "text"])
def test_each_file_source(spark, tmp_path, kind):
    df = spark.createDataFrame([("x",), ("y",)], "value string")
    df.write.format(kind).save(f"{tmp_path}/in")
    found = file_stream(spark, f"{tmp_path}/in", "value STRING", kind)
    finish(append_files(found, f"{tmp_path}/out", f"{tmp_path}/state"))
    assert sorted(r.value for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["x", "y"]


def test_fixed_records(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.bin").write_bytes(b"aabbcc")
    finish(append_files(fixed_records(spark, f"{tmp_path}/in", 2), f"{tmp_path}/out", f"{tmp_path}/state"))
    assert sorted(bytes(r.record) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [b"aa", b"bb", b"cc"]


def test_partitioned_file_sink(spark, files, tmp_path):
    finish(append_files(stream(spark, files).select("user", "value"), f"{tmp_path}/out", f"{tmp_path}/state", ["user"]))
    assert sorted(p.name for p in (tmp_path / "out").glob("user=*")) == ["user=a", "user=b", "user=z"]


def test_row_writer(spark, files, tmp_path):
    """A row writer with open, process and close, on the executors."""
    target = str(tmp_path / "rows")

    class Writer:
        def open(self, partition, epoch):
            import os

            os.makedirs(target, exist_ok=True)
            self.out = open(f"{target}/{epoch}-{partition}.txt", "w")
            return True

        def process(self, row):
            self.out.write(f"{row.user}\n")

        def close(self, error):
            self.out.close()

    finish(stream(spark, files).writeStream.foreach(Writer()).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start())
    names = [line for p in (tmp_path / "rows").iterdir() for line in p.read_text().split()]
    assert sorted(names) == ["a", "a", "a", "a", "b", "b", "b", "b", "z"]


def test_centroids_follow_the_batches(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([0.0, 2.0],), ([10.0, 10.0],)], "x array<double>")
    model = CentroidModel([[1.0, 1.0], [9.0, 9.0]])
    model.update(df, "x")
    assert model.centres == [[0.0, 1.0], [10.0, 10.0]] and model.weights == [2.0, 1.0]
    assert [r.n for r in df.select(nearest(F.col("x"), model.centres).alias("n")).collect()] == [0, 0, 1]


def test_logistic_steps(spark):
    df = spark.createDataFrame([(x / 10, float(x > 0)) for x in range(-10, 11)], "x double, y double")
    model = GradientModel(1, step=2.0, logistic=True)
    for _ in range(12):
        model.update(df, ["x"], "y")
    assert model.weights[1] > 1


def test_row_files_of_a_repeated_and_a_failed_task(spark, tmp_path):
    """A task that runs again replaces its file; one that fails leaves nothing that a reader sees."""
    from pyspark.sql import Row

    from millrace.streaming.sinks import RowFile

    def task(rows, batch, partition, error=None):
        writer = RowFile(f"file:{tmp_path}/out")
        assert writer.open(partition, batch)
        for r in rows:
            writer.process(Row(id=r, inner=Row(x=None, text="é\n")))
        writer.close(error)

    task([1, 2], 0, 0)
    task([1, 2], 0, 0)
    task([3], 0, 1)
    task([9], 1, 0, ValueError("lost"))
    back = spark.read.schema("id int, inner struct<x: int, text: string>").json(f"{tmp_path}/out")
    assert sorted((r.id, r.inner.x, r.inner.text) for r in back.collect()) == [(i, None, "é\n") for i in (1, 2, 3)]
    assert len(list((tmp_path / "out").iterdir())) == 2


def test_a_restarted_table_stream_goes_on(spark, tmp_path):
    from millrace.streaming.sinks import finish, row_files
    from millrace.streaming.sources import file_stream

    def more(ids):
        spark.createDataFrame([(i,) for i in ids], "id int").write.mode("append").json(f"{tmp_path}/in")
        stream = file_stream(spark, f"{tmp_path}/in", "id int", "json")
        finish(row_files(stream, f"{tmp_path}/out", f"{tmp_path}/state"))
        return sorted(r.id for r in spark.read.schema("id int").json(f"{tmp_path}/out").collect())

    assert more([1, 2, 3]) == [1, 2, 3]
    assert more([4]) == [1, 2, 3, 4]
