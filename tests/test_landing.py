"""Landed files to bronze to silver, on hand-made rows for every null and malformed rule."""

import io
import zipfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from millrace.functions import clean
from millrace.plans import jobs
from millrace.sources import landing
from millrace.sources.layers import LayerTable
from millrace.sources.links import not_landed, page_links

HEADER = ";".join(landing.LANDING_COLUMNS)


def row(**cells):
    base = {
        "Regiao - Sigla": "S", "Estado - Sigla": "PR", "Municipio": "CITY", "Revenda": "SHOP", "CNPJ da Revenda": " 12.345.678/0001-90 ",
        "Nome da Rua": "STREET", "Numero Rua": "7", "Complemento": "", "Bairro": "AREA", "Cep": "01310-100", "Produto": "FUEL",
        "Data da Coleta": "06/01/2023", "Valor de Venda": "6,499", "Valor de Compra": "", "Unidade de Medida": "R$ / litro", "Bandeira": "B",
    }
    base.update(cells)
    return ";".join(base.values())


def write(folder, name, lines, header=HEADER, bom=False):
    text = "\n".join([header, *lines]) + "\n"
    (folder / name).write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.encode())


@pytest.fixture()
def zone(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


def bronze(spark, zone):
    return jobs.bronze_rows(landing.read_delimited(spark, f"{zone}/*.csv"))


def test_plain_row(spark, zone):
    write(zone, "a.csv", [row()])
    got = bronze(spark, zone).first()
    assert got.data_da_coleta == date(2023, 1, 6)
    assert got.valor_de_venda == pytest.approx(6.499, rel=1e-6) and got.valor_de_compra is None
    assert (got.cnpj_da_revenda, got.cep, got.regiao_sigla) == ("12345678000190", "01310100", "S")


def test_bad_days_are_dropped_and_listed(spark, zone):
    write(zone, "a.csv", [row(**{"Data da Coleta": d}) for d in ("bad", "", "31/02/2023", "6/1/2023", "06/01/2023")])
    landed = landing.read_delimited(spark, f"{zone}/*.csv")
    assert jobs.bronze_rows(landed).count() == 1
    rejects = jobs.bronze_rejects(landed)
    assert rejects.count() == 4 and {tuple(r.reasons) for r in rejects.collect()} == {("bad day",)}


def test_prices(spark, zone):
    write(zone, "a.csv", [row(**{"Valor de Venda": v}) for v in ("1.234,56", "", "abc", "5")])
    assert sorted(r.valor_de_venda or -1 for r in bronze(spark, zone).collect()) == [-1, -1, -1, 5]


@pytest.mark.parametrize(("text", "want"), [
    ("S/N", None), ("1,234", 1234), ("12.9", 12), (" 7 ", 7), ("3000000000", None), ("", None), ("1e3", None), ("-5", -5),
    ("NaN", None), ("1.", 1), (".5", 0), ("2147483647", 2147483647), (None, None),
])
def test_lenient_int(spark, text, want):
    df = spark.createDataFrame([(text,)], "x string")
    once = df.select(clean.parse_int(F.col("x")).alias("x"))
    assert once.first().x == want
    assert once.select(clean.parse_int(F.col("x").cast("string")).alias("x")).first().x == want


def test_number_separators(spark):
    df = spark.createDataFrame([("1.234,56",)], "x string")
    assert df.select(clean.parse_number(F.col("x"))).first()[0] is None
    assert df.select(clean.parse_number(F.col("x"), thousands=".", kind="double")).first()[0] == 1234.56


def test_rules_do_not_lean_on_the_ansi_flag(spark):
    df = spark.createDataFrame([("x", "bad")], "a string, b string")
    got = []
    for flag in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", flag)
        got.append(df.select(clean.parse_int(F.col("a")), clean.parse_day(F.col("b")), clean.parse_number(F.col("a"))).first())
    spark.conf.set("spark.sql.ansi.enabled", "true")
    assert got[0] == got[1] == (None, None, None)


def test_cleaning_twice_changes_nothing(spark):
    df = spark.createDataFrame([(" 1.2-3/4 ", "1-2")], "i string, p string")
    once = df.select(clean.clean_identifier(F.col("i")).alias("i"), clean.clean_postcode(F.col("p")).alias("p"))
    twice = once.select(clean.clean_identifier(F.col("i")).alias("i"), clean.clean_postcode(F.col("p")).alias("p"))
    assert once.first() == twice.first() == ("1234", "12")


def test_region_labels(spark, zone):
    codes = ["N", "NE", "S", "SE", "CO", "XX", ""]
    write(zone, "a.csv", [row(**{"Regiao - Sigla": c}) for c in codes])
    got = {r.regiao_sigla for r in jobs.station_rows(bronze(spark, zone)).collect()}
    assert got == {"Norte", "Nordeste", "Sul", "Sudeste", "Centro-Oeste", None}


def test_short_long_quoted_and_marked_files(spark, zone):
    short = ";".join(row().split(";")[:15])
    write(zone, "a.csv", [short, row() + ";extra", row(Complemento='"a;b"')], bom=True)
    write(zone, "empty.csv", [])
    got = bronze(spark, zone).collect()
    assert len(got) == 3
    assert sorted(r.bandeira or "" for r in got) == ["", "B", "B"]
    assert {r.complemento for r in got} >= {"a;b"}


def test_equal_rows_in_two_files(spark, zone):
    write(zone, "a.csv", [row(), row()])
    write(zone, "b.csv", [row()])
    rows = bronze(spark, zone)
    assert rows.count() == 3 and jobs.sale_rows(rows).count() == 1 and jobs.station_rows(rows).count() == 1


def test_reordered_header_is_refused(spark, zone):
    names = landing.LANDING_COLUMNS
    write(zone, "a.csv", [row()], header=";".join([names[1], names[0], *names[2:]]))
    with pytest.raises(Exception, match="(?s)header.*a.csv"):
        bronze(spark, zone).collect()


def test_no_files(spark, tmp_path):
    assert landing.read_delimited(spark, f"{tmp_path}/none/*.csv") is None
    config = jobs.LayerConfig(f"{tmp_path}/none/*.csv", *[f"{tmp_path}/{n}" for n in ("b", "s", "v")])
    assert jobs.run_layers(spark, config) is False


def test_column_names():
    assert clean.clean_names(["Regiao - Sigla", "Cep"]) == ["regiao_sigla", "cep"]
    with pytest.raises(ValueError, match="clash"):
        clean.clean_names(["a b", "a-b".replace("-", " ")])


def test_layers_run_end_to_end(spark, zone, tmp_path):
    write(zone, "a.csv", [row(), row(**{"Data da Coleta": "07/01/2023", "Nome da Rua": "NEW"}), row(**{"Data da Coleta": "bad"})])
    config = jobs.LayerConfig(f"{zone}/*.csv", *[f"{tmp_path}/{n}" for n in ("bronze", "stations", "sales")])
    for _ in range(2):
        assert jobs.run_layers(spark, config) is True
    assert LayerTable(spark, config.bronze).read().count() == 2
    stations = LayerTable(spark, config.stations).read()
    assert stations.count() == 2 and dict(stations.dtypes)["numero_rua"] == "int"
    assert jobs.latest_stations(stations).first().nome_da_rua == "NEW"
    assert LayerTable(spark, config.sales).read().columns == [
        "cnpj", "produto", "valor_de_venda", "valor_de_compra", "unidade_de_medida", "data_da_coleta"]


def test_layers_stop_on_an_empty_layer(spark, zone, tmp_path):
    write(zone, "a.csv", [row(**{"Data da Coleta": "bad"})])
    config = jobs.LayerConfig(f"{zone}/*.csv", *[f"{tmp_path}/{n}" for n in ("bronze", "stations", "sales")])
    assert jobs.run_layers(spark, config) is False
    assert LayerTable(spark, config.stations).current() is None


def archive(path, members):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)
    path.write_bytes(data.getvalue())


def test_archive_members_are_landed_once(spark, tmp_path):
    zips, zone = tmp_path / "zips", tmp_path / "zone"
    zips.mkdir()
    archive(zips / "x.zip", {"d/one.csv": "1", "two.CSV": "2", "note.txt": "n"})
    assert sorted(r.file_name for r in landing.land_archives(spark, str(zips), str(zone)).collect()) == ["one.csv", "two.CSV"]
    assert (zone / "one.csv").read_text() == "1" and (zone / "two.CSV").read_text() == "2"
    assert landing.land_archives(spark, str(zips), str(zone)).count() == 0
    assert sorted(r.file_name for r in landing.landed_files(spark, str(zone)).collect()) == ["one.csv", "two.CSV"]


def test_archives_with_members_of_one_name(spark, tmp_path):
    zips, zone = tmp_path / "zips", tmp_path / "zone"
    zips.mkdir()
    archive(zips / "a.zip", {"prices.csv": "1", "own a.csv": "a"})
    archive(zips / "b.zip", {"d/prices.csv": "1", "e/prices.csv": "1"})
    archive(zips / "none.zip", {})
    assert sorted(r.file_name for r in landing.land_archives(spark, str(zips), str(zone)).collect()) == ["own a.csv", "prices.csv"]
    assert sorted(p.name for p in zone.iterdir() if not p.name.startswith(".")) == ["own a.csv", "prices.csv"]
    archive(zips / "c.zip", {"prices.csv": "2"})
    with pytest.raises(ValueError, match="prices.csv"):
        landing.land_archives(spark, str(zips), str(tmp_path / "other"))
    assert not (tmp_path / "other").exists()


def test_archive_member_past_the_bound_stops(spark, tmp_path):
    archive(tmp_path / "x.zip", {"big.csv": "x" * 100})
    frame = spark.read.format("binaryFile").load(f"{tmp_path}/x.zip")
    with pytest.raises(Exception, match="big.csv"):
        landing.expand_archives(frame, max_member_bytes=10).collect()


def test_links(spark):
    html = """<p><a href="/x/keep/a.csv">1</a><A class=b HREF='/keep/b.zip'>2</A><a>none</a><a href="/other/c">3</a>
    <abbr href="/keep/no">z</abbr><a href="/x/keep/a.csv">again</a></p>"""
    pages = spark.createDataFrame([(1, html), (2, "<p>no links</p>")], "page_id int, html string")
    got = page_links(pages, marker="keep/")
    assert [(r.href, r.file_name, r.file_stem) for r in got.collect()] == [
        ("/x/keep/a.csv", "a.csv", "a"), ("/keep/b.zip", "b.zip", "b"), ("/x/keep/a.csv", "a.csv", "a")]
    landed = spark.createDataFrame([("a.csv",)], "file_name string")
    assert [r.file_name for r in not_landed(got, landed).collect()] == ["b.zip"]
