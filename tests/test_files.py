"""Readers, writers and tables over files: what lands on disk and what comes back."""

import os
from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F


@pytest.fixture()
def df(spark):
    return spark.createDataFrame([(1, "a", 1.5), (2, "b", None), (3, "a", 2.5)], "id int, k string, v double")


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def test_save_modes(spark, df, tmp_path):
    path = f"{tmp_path}/t"
    df.write.save(path)
    with pytest.raises(AnalysisException):
        df.write.mode("error").save(path)
    df.write.mode("ignore").save(path)
    assert spark.read.load(path).count() == 3
    df.write.mode("append").save(path)
    assert spark.read.load(path).count() == 6
    df.limit(1).write.mode("overwrite").save(path)
    assert spark.read.load(path).count() == 1


@pytest.mark.parametrize("kind", ["json", "parquet", "csv", "orc"])
def test_formats_round_trip(spark, df, tmp_path, kind):
    df.write.format(kind).save(f"{tmp_path}/t")
    assert rows(spark.read.schema("id INT, k STRING, v DOUBLE").format(kind).load(f"{tmp_path}/t")) == rows(df)


def test_compression(df, tmp_path):
    df.write.parquet(f"{tmp_path}/p", compression="zstd")
    df.write.json(f"{tmp_path}/j", compression="gzip")
    assert any(".zstd." in n for n in os.listdir(tmp_path / "p")) and any(n.endswith(".gz") for n in os.listdir(tmp_path / "j"))


def test_partition_folders_and_pruning(spark, df, tmp_path):
    df.write.partitionBy("k").parquet(f"{tmp_path}/t")
    assert {"k=a", "k=b"} <= set(os.listdir(tmp_path / "t"))
    one = spark.read.parquet(f"{tmp_path}/t").where("k = 'a'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(k" in plan and one.count() == 2


def test_dynamic_partition_overwrite(spark, df, tmp_path):
    df.write.partitionBy("k").parquet(f"{tmp_path}/t")
    new = spark.createDataFrame([(9, "a", 9.0)], "id int, k string, v double")
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("k").parquet(f"{tmp_path}/t")
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/t").collect()) == [2, 9]


@pytest.fixture()
def table_name(spark, tmp_path):
    for name in ("files_t", "files_u"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.conf.set("spark.sql.sources.default", "parquet")
    yield "files_t"
    for name in ("files_t", "files_u"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_table_write_insert_and_read(spark, df, tmp_path, table_name):
    df.write.option("path", f"{tmp_path}/t").saveAsTable(table_name)
    df.write.insertInto(table_name)
    assert spark.table(table_name).count() == 6 and spark.read.table(table_name).count() == 6
    df.limit(1).write.insertInto(table_name, overwrite=True)
    assert spark.table(table_name).count() == 1


def test_buckets_join_without_a_shuffle(spark, df, tmp_path, table_name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in ("files_t", "files_u"):
        df.write.bucketBy(4, "id").sortBy("id").option("path", f"{tmp_path}/{name}").saveAsTable(name)
    joined = spark.table("files_t").join(spark.table("files_u"), "id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and joined.count() == 3


def test_create_by_writer_v2(spark, df, tmp_path, table_name):
    df.writeTo(table_name).using("parquet").option("path", f"{tmp_path}/t").partitionedBy(F.col("k")).create()
    assert spark.table(table_name).count() == 3 and (tmp_path / "t" / "k=a").exists()


def test_tables_over_files(spark, df, tmp_path, table_name):
    df.write.partitionBy("k").parquet(f"{tmp_path}/t")
    spark.catalog.createTable(table_name, path=f"{tmp_path}/t", source="parquet", schema=None)
    spark.catalog.recoverPartitions(table_name)
    assert spark.table(table_name).count() == 3
    spark.catalog.createExternalTable("files_u", path=f"{tmp_path}/t/k=a", source="parquet")
    assert spark.table("files_u").count() == 2


def test_reader_options(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2023-01-05\n2,NA\nbad,row,more\n")
    reader = spark.read.schema("x INT, y DATE").option("header", True).option("nullValue", "NA")
    assert rows(reader.csv(f"{tmp_path}/a.csv", mode="DROPMALFORMED"))[0] == (1, date(2023, 1, 5))
    assert reader.csv(f"{tmp_path}/a.csv", mode="PERMISSIVE").count() == 3
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        reader.csv(f"{tmp_path}/a.csv", mode="FAILFAST").collect()


def test_json_modes(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"n": "x", "a": 1}\n{"n": "y"}\n{broken\n')
    schema = "n STRING, a INT, bad STRING"
    kept = spark.read.schema(schema).json(f"{tmp_path}/a.json", columnNameOfCorruptRecord="bad").cache()
    assert kept.where("bad IS NOT NULL").count() == 1
    assert spark.read.schema("n STRING, a INT").json(f"{tmp_path}/a.json", mode="DROPMALFORMED").count() == 2
    (tmp_path / "b.json").write_text('[{"n": "x"},\n {"n": "y"}]')
    assert spark.read.schema("n STRING").json(f"{tmp_path}/b.json", multiLine=True).count() == 2


def test_text_reader(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    (tmp_path / "skip.log").write_text("no\n")
    assert [r.value for r in spark.read.text(str(tmp_path), pathGlobFilter="*.txt").collect()] == ["one", "two"]
    assert spark.read.text(f"{tmp_path}/a.txt", wholetext=True).first().value == "one\ntwo\n"


def test_merged_schemas(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/t/p=1")
    spark.range(2).withColumn("x", F.lit(1)).write.parquet(f"{tmp_path}/t/p=2")
    assert set(spark.read.option("mergeSchema", True).parquet(f"{tmp_path}/t").columns) == {"id", "x", "p"}


def test_rows_from_pandas_and_local(spark):
    import pandas as pd

    assert spark.createDataFrame(pd.DataFrame({"a": [1, 2]})).count() == 2
    assert spark.createDataFrame([{"a": 1}, {"a": None}]).where("a IS NULL").count() == 1
    assert [r.id for r in spark.range(2, 8, 3).collect()] == [2, 5]


def test_foreach_on_executors(df, tmp_path):
    target = str(tmp_path)

    def note(part):
        import uuid

        ids = [str(r.id) for r in part]
        if ids:
            with open(f"{target}/{uuid.uuid4().hex}", "w") as out:
                out.write("\n".join(ids))

    df.foreachPartition(note)
    assert sorted(x for n in os.listdir(target) for x in open(f"{target}/{n}").read().split()) == ["1", "2", "3"]
    df.foreach(lambda r: open(f"{target}/row{r.id}", "w").close())
    assert {"row1", "row2", "row3"} <= set(os.listdir(target))


def test_observed_metrics(spark):
    """In a session of its own: the object stays there and keeps fitted classifiers from tasks."""
    from pyspark.sql import Observation

    seen = Observation("m")
    df = spark.newSession().createDataFrame([(1, 1.5), (2, None), (3, 2.5)], "id int, v double")
    df.observe(seen, F.count("*").alias("n"), F.max("v").alias("top")).write.format("noop").mode("overwrite").save()
    assert seen.get == {"n": 3, "top": 2.5}


def test_partitioned_table_edits(spark, df, tmp_path, table_name):
    from millrace.sources import tables

    tables.create(df, table_name, f"{tmp_path}/t", ["k"])
    with pytest.raises(AnalysisException):
        tables.create(df, table_name, f"{tmp_path}/t", ["k"])
    tables.append(spark.createDataFrame([(4.0, "b", 4)], "v double, k string, id int"), table_name)
    assert spark.table(table_name).count() == 4
    tables.overwrite_partitions(spark.createDataFrame([(9, "a", 9.0)], "id int, k string, v double"), table_name)
    assert sorted(r.id for r in spark.table(table_name).collect()) == [2, 4, 9]
    tables.overwrite_where(spark.createDataFrame([(5, "c", 5.0)], "id int, k string, v double"), table_name, F.col("v") >= 4)
    assert sorted((r.id, r.k) for r in spark.table(table_name).collect()) == [(2, "b"), (5, "c")]
    tables.overwrite_where(spark.createDataFrame([], "id int, k string, v double"), table_name, F.col("k") == "c")
    assert [r.id for r in spark.table(table_name).collect()] == [2]
    tables.replace(df.select("k", "id"), table_name, f"{tmp_path}/t")
    assert set(spark.table(table_name).columns) == {"k", "id"}
    with pytest.raises(ValueError, match="no table"):
        tables.replace(df, "files_none", f"{tmp_path}/n")
