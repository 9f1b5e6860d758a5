import io
import resource
import zipfile

import pytest
from pyspark.sql import functions as F

from millrace.sources import archives as A
from millrace.sources import landing
from millrace.streaming.sinks import append_files, finish


def archive(path, members, kind=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", kind) as z:
        for name, data in members.items():
            z.writestr(name, data)


def lines(df):
    return sorted((r.member, r.start, bytes(r.line)) for r in df.collect())


def want(name, data):
    out, at = [], 0
    for line in data.split(b"\n"):
        if line or at + len(line) < len(data):
            out.append((name, at, line.removesuffix(b"\r")))
        at += len(line) + 1
    return out


@pytest.mark.parametrize("kind", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_every_line_once(spark, tmp_path, kind, size, monkeypatch):
    monkeypatch.setattr(A, "READ", 11)
    data = b"head\r\n\r\n" + b"\n".join(b"x" * (n % 23) for n in range(40)) + b"\xff\xfe;last"
    members = {"d/a.csv": data, "b.CSV": b"one line\n", "empty.csv": b"", "note.txt": b"no"}
    (tmp_path / "in").mkdir()
    archive(tmp_path / "z.zip", members, kind)
    archive(tmp_path / "in" / "none.zip", {})
    plan = A._Plans({"folder": f"file:{tmp_path}", "range": str(size)})
    found = [row for part in plan.stretches(plan.archives()) for batch in plan.read(part) for row in batch.to_pylist()]
    expected = want("b.CSV", members["b.CSV"]) + want("d/a.csv", data)
    assert sorted((r["member"], r["start"], r["line"]) for r in found) == sorted(expected)
    if kind == zipfile.ZIP_STORED:
        assert len(plan.stretches(plan.archives())) == sum(-(-len(m) // size) for n, m in members.items() if n.lower().endswith("csv"))
    assert lines(A.archive_lines(spark, str(tmp_path), range_bytes=max(size, 64))) == sorted(expected)


def test_no_archives(spark, tmp_path):
    assert A.archive_lines(spark, str(tmp_path)).collect() == [] and A.archive_lines(spark, str(tmp_path / "none")).collect() == []


def test_a_large_member_is_read_in_bounded_memory(tmp_path):
    """300 MB of lines in a deflated member: what is held grows by the pieces read, not by the member."""
    row = b"0123456789" * 10 + b"\n"
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED, compresslevel=1) as z, z.open("big.csv", "w", force_zip64=True) as m:
        for _ in range(300):
            m.write(row * 9901)
    plan = A._Plans({"folder": f"file:{tmp_path}"})
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    part, = plan.stretches(plan.archives())
    assert sum(b.num_rows for b in plan.read(part)) == 300 * 9901
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 150_000  # kB


def test_stream_goes_on_after_a_restart(spark, tmp_path):
    zips, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    zips.mkdir()
    run = lambda: finish(append_files(A.archive_line_stream(spark, str(zips)).select("member", "line"), out, state))
    archive(zips / "a.zip", {"a.csv": "1\n2\n"})
    run()
    run()
    archive(zips / "b.zip", {"b.csv": "3\n"})
    run()
    got = spark.read.parquet(out).select("member", F.col("line").cast("string")).collect()
    assert sorted(map(tuple, got)) == [("a.csv", "1"), ("a.csv", "2"), ("b.csv", "3")]


def test_written_archives(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 3).selectExpr("concat('é', id) AS line")
    paths = [r.path for r in A.write_archives(rows, str(tmp_path / "o"), "head").collect()]
    again = [r.path for r in A.write_archives(rows, str(tmp_path / "o"), "head").collect()]
    assert sorted(paths) == sorted(again) and len(list((tmp_path / "o").iterdir())) == 3
    got = A.archive_lines(spark, str(tmp_path / "o")).where("start > 0").select(F.col("line").cast("string").alias("line"))
    assert got.exceptAll(rows).isEmpty() and got.count() == 1000


def test_a_landed_name_with_other_bytes_is_refused(spark, tmp_path):
    zips, zone = tmp_path / "zips", tmp_path / "zone"
    zips.mkdir()
    archive(zips / "a.zip", {"one.csv": "1", "two.csv": "22"})
    assert landing.land_archives(spark, str(zips), str(zone)).count() == 2
    assert landing.land_archives(spark, str(zips), str(zone)).count() == 0
    for data in ("2", "other size"):
        archive(zips / "a.zip", {"one.csv": data, "two.csv": "22", "new.csv": "3"})
        with pytest.raises(ValueError, match="other bytes: one.csv"):
            landing.land_archives(spark, str(zips), str(zone))
    assert sorted(p.name for p in zone.iterdir() if p.suffix == ".csv") == ["one.csv", "two.csv"] and io.open(zone / "one.csv").read() == "1"
