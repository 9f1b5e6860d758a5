"""Models updated batch by batch: sums are made on the executors, the few weights on the driver.

`train` keeps the weights after each batch in a `ModelLog` on the shared store, so a batch
that is run again starts from the weights before it, and a restart goes on from the last.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def squared_distance(x: Column, centre: Sequence[float]) -> Column:
    point = F.array(*[F.lit(float(c)) for c in centre])
    gaps = F.zip_with(x, point, lambda a, b: (a - b) * (a - b))
    return F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g)


def nearest(x: Column, centres: Sequence[Sequence[float]]) -> Column:
    """Number of the nearest centre."""
    ranked = F.array(*[F.struct(squared_distance(x, c).alias("d"), F.lit(n).alias("n")) for n, c in enumerate(centres)])
    return F.array_min(ranked)["n"]


class CentroidModel:
    """K-means over a stream: the weight of all centres decays, each batch pulls its nearest ones."""

    def __init__(self, centres: Sequence[Sequence[float]], decay: float = 1.0):
        self.centres = [list(map(float, c)) for c in centres]
        self.weights = [0.0] * len(centres)
        self.decay = decay

    def update(self, batch: DataFrame, column: str) -> None:
        width = len(self.centres[0])
        x = F.col(column)
        sums = [F.sum(x[i]).alias(f"s{i}") for i in range(width)]
        rows = batch.groupBy(nearest(x, self.centres).alias("n")).agg(F.count("*").alias("c"), *sums).collect()  # one per centre
        self.weights = [w * self.decay for w in self.weights]
        for row in rows:
            old = self.weights[row.n]
            total = old + row.c
            self.centres[row.n] = [
                (old * a + row[f"s{i}"]) / total for i, a in enumerate(self.centres[row.n])
            ]
            self.weights[row.n] = total

    def state(self) -> dict:
        return {"centres": self.centres, "weights": self.weights}

    def load(self, state: dict) -> None:
        self.centres, self.weights = [list(c) for c in state["centres"]], list(state["weights"])

    def assign(self, df: DataFrame, column: str, name: str = "cluster") -> DataFrame:
        return df.withColumn(name, nearest(F.col(column), self.centres))


class GradientModel:
    """Linear or logistic regression by one gradient step per batch."""

    def __init__(self, width: int, step: float = 0.1, logistic: bool = False):
        self.weights = [0.0] * (width + 1)
        self.step = step
        self.logistic = logistic
        self.batches = 0

    def score(self, features: Sequence[str]) -> Column:
        out = F.lit(self.weights[0])
        for w, f in zip(self.weights[1:], features):
            out = out + F.lit(w) * F.col(f)
        return 1 / (1 + F.exp(-out)) if self.logistic else out

    def state(self) -> dict:
        return {"weights": self.weights, "batches": self.batches}

    def load(self, state: dict) -> None:
        self.weights, self.batches = list(state["weights"]), state["batches"]

    def update(self, batch: DataFrame, features: Sequence[str], label: str) -> None:
        """The step shrinks with the root of the batch number."""
        error = self.score(features) - F.col(label)
        row = batch.agg(F.avg(error), *[F.avg(error * F.col(f)) for f in features]).first()
        if row[0] is None:
            return
        self.batches += 1
        rate = self.step / self.batches ** 0.5
        self.weights = [w - rate * g for w, g in zip(self.weights, row)]


class ModelLog:
    """The state of a model after each batch, at `path/batch=<number>`, published by Spark's own commit.

    The last `keep` states stay; only the newest batch is ever run again.
    """

    def __init__(self, spark: SparkSession, path: str, keep: int = 10):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keep = keep
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def batches(self) -> list[int]:
        """Numbers of the batches whose state is whole."""
        if not self._fs.exists(self._path(self.path)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.path))]
        done = [n for n in names if n.startswith("batch=") and self._fs.exists(self._path(f"{self.path}/{n}/_SUCCESS"))]
        return sorted(int(n.removeprefix("batch=")) for n in done)

    def rows(self, batch: int | None = None) -> DataFrame:
        """The state after a batch, or after the newest, as one row with the JSON text `state`."""
        number = self.batches()[-1] if batch is None else batch
        return self.spark.read.schema("state STRING").parquet(f"{self.path}/batch={number}")

    def before(self, batch: int) -> dict | None:
        """The state that `batch` starts from; None is the model's own start."""
        known = self.batches()
        if known and known[-1] > batch:
            raise ValueError(f"{self.path} is past batch {batch}: it belongs to another checkpoint")
        earlier = [n for n in known if n < batch]
        if batch > 0 and (not earlier or earlier[-1] != batch - 1):
            raise ValueError(f"{self.path} lacks the state after batch {batch - 1}")
        return json.loads(self.rows(earlier[-1]).first().state) if earlier else None

    def latest(self) -> dict | None:
        return json.loads(self.rows().first().state) if self.batches() else None

    def write(self, batch: int, state: dict) -> None:
        row = self.spark.range(1).select(F.lit(json.dumps(state)).alias("state"))
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        for old in self.batches():
            if old <= batch - self.keep:
                self._fs.delete(self._path(f"{self.path}/batch={old}"), True)


def train(
    stream: DataFrame,
    model: CentroidModel | GradientModel,
    update: Callable[[DataFrame], None],
    log: ModelLog,
    checkpoint: str,
) -> StreamingQuery:
    """Run `update`, which must change `model` by its batch alone, on every batch, each counted once.

    `model` takes the newest state of the log first, so it can score before a batch has come.
    """
    start = model.state()
    known = log.latest()
    if known is not None:
        model.load(known)

    def step(rows: DataFrame, number: int) -> None:
        model.load(log.before(number) or start)
        update(rows)
        log.write(number, model.state())

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
