"""Tables written between steps keep their rows and are stored compactly."""

import glob

import pyarrow.parquet as pq

from millrace.llm.frames import written


def test_written_keeps_rows_and_uses_zstd(spark):
    rows = [(i, "the same words again " * (i % 7) if i % 5 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    back = written(df, "zstd-check")
    assert sorted(back.collect()) == sorted(df.collect())
    path = back.inputFiles()[0]
    files = [f for f in glob.glob(path.replace("file://", "").rsplit("/", 1)[0] + "/*.parquet")]
    assert files
    for f in files:
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                assert meta.row_group(g).column(c).compression == "ZSTD"
