"""Models over streams: a batch counts once, whatever is run again."""

import pytest
from pyspark.sql import functions as F

from millrace.streaming.learning import CentroidModel, GradientModel, ModelLog, train
from millrace.streaming.sinks import finish
from millrace.streaming.sources import file_stream

SCHEMA = "x double, y double"


def put(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(str(folder))


def run(spark, tmp_path, log, name="state"):
    model = GradientModel(1, step=0.5)
    finish(train(file_stream(spark, f"{tmp_path}/in", SCHEMA, "json"), model, lambda rows: model.update(rows, ["x"], "y"), log, f"{tmp_path}/{name}"))
    return model


BATCHES = [[(1.0, 2.0), (2.0, 3.0)], [(0.0, 1.0)], [(3.0, 1.0), (-1.0, 0.5)]]


def plain(spark, batches):
    model = GradientModel(1, step=0.5)
    for rows in batches:
        model.update(spark.createDataFrame(rows, SCHEMA), ["x"], "y")
    return model.weights


def test_crash_repeat_and_restart(spark, tmp_path, monkeypatch):
    log = ModelLog(spark, f"{tmp_path}/log", keep=2)
    put(spark, tmp_path / "in", BATCHES[0])
    assert run(spark, tmp_path, log).weights == pytest.approx(plain(spark, BATCHES[:1]))
    put(spark, tmp_path / "in", BATCHES[1])
    write = ModelLog.write

    # the state is written, but the stream does not hear of it: the batch is run again
    def half(self, batch, state):
        write(self, batch, state)
        raise OSError("stop")

    monkeypatch.setattr(ModelLog, "write", half)
    with pytest.raises(Exception, match="stop"):
        run(spark, tmp_path, log)
    monkeypatch.undo()
    assert log.batches() == [0, 1]
    assert run(spark, tmp_path, log).weights == pytest.approx(plain(spark, BATCHES[:2]))
    # nothing new: the model is what the log holds
    assert run(spark, tmp_path, log).weights == pytest.approx(plain(spark, BATCHES[:2]))
    put(spark, tmp_path / "in", BATCHES[2])
    assert run(spark, tmp_path, log).weights == pytest.approx(plain(spark, BATCHES))
    assert log.batches() == [1, 2]
    with pytest.raises(Exception, match="another checkpoint"):
        run(spark, tmp_path, log, "other")


def test_state_round_trip_and_unfinished(spark, tmp_path):
    log = ModelLog(spark, f"{tmp_path}/log")
    assert log.latest() is None and log.before(0) is None
    model = CentroidModel([[0.1, 0.2], [1 / 3, 9.0]], decay=0.5)
    model.update(spark.createDataFrame([([0.1, 0.7],)], "x array<double>"), "x")
    # the weight of a centre without rows decays as well
    model.weights[1] = 4.0
    model.update(spark.createDataFrame([([0.1, 0.7],)], "x array<double>"), "x")
    assert model.weights == [1.5, 2.0]
    log.write(0, model.state())
    spark.range(1).select(F.lit("{").alias("state")).write.parquet(f"{tmp_path}/log/batch=1")
    (tmp_path / "log" / "batch=1" / "_SUCCESS").unlink()
    again = CentroidModel([[0.0, 0.0]])
    again.load(log.before(1))
    assert again.state() == model.state() and log.batches() == [0]
    with pytest.raises(ValueError, match="lacks"):
        log.before(3)
