"""The layer jobs: bronze from landed files, then the two silver tables from bronze.

Each job is a function from frame to frame; `run_layers` only reads, writes and keeps order.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.clean import (
    clean_identifier, clean_names, clean_postcode, comma_text, label_of, parse_day, parse_int, parse_number,
)
from millrace.plans.registry import Tables, case
from millrace.sources.landing import read_delimited
from millrace.sources.layers import RETENTION_HOURS, LayerTable

# Region codes and their names.
REGION_LABELS = {"N": "Norte", "NE": "Nordeste", "CO": "Centro-Oeste", "SE": "Sudeste", "S": "Sul"}

IDENTIFIER, POSTCODE, DAY = "cnpj_da_revenda", "cep", "data_da_coleta"
PRICES = ("valor_de_compra", "valor_de_venda")


def typed_rows(landed: DataFrame) -> DataFrame:
    """Landed text rows with clean names and typed cells; a bad cell is null."""
    named = landed.toDF(*clean_names(landed.columns))
    rules = {
        DAY: parse_day(F.col(DAY)),
        IDENTIFIER: clean_identifier(F.col(IDENTIFIER)),
        POSTCODE: clean_postcode(F.col(POSTCODE)),
        **{p: parse_number(F.col(p)) for p in PRICES},
    }
    return named.select(*[rules.get(c, F.col(c)).alias(c) for c in named.columns])


def bronze_rows(landed: DataFrame) -> DataFrame:
    """Typed rows that have a collection day."""
    return typed_rows(landed).where(F.col(DAY).isNotNull())


def bronze_rejects(landed: DataFrame) -> DataFrame:
    """Landed rows the bronze layer drops or blanks, each with its reasons."""
    names = clean_names(landed.columns)
    raw = landed.toDF(*names)
    checks = {
        "bad day": parse_day(F.col(DAY)).isNull(),
        **{
            f"bad {p}": parse_number(F.col(p)).isNull() & F.col(p).isNotNull() & (F.trim(p) != "")
            for p in PRICES
        },
    }
    reasons = F.array_compact(F.array(*[F.when(test, F.lit(why)) for why, test in checks.items()]))
    return raw.select("*", reasons.alias("reasons")).where(F.size("reasons") > 0)


def station_rows(bronze: DataFrame) -> DataFrame:
    """Register rows of the stations: one per station and day, region by name."""
    return bronze.select(
        label_of(F.col("regiao_sigla"), REGION_LABELS).alias("regiao_sigla"),
        "estado_sigla",
        "municipio",
        F.col("revenda").alias("nome_posto"),
        clean_identifier(F.col(IDENTIFIER)).alias("cnpj"),
        "nome_da_rua",
        parse_int(F.col("numero_rua")).alias("numero_rua"),
        "complemento",
        "bairro",
        clean_postcode(F.col(POSTCODE)).alias("cep"),
        DAY,
        "bandeira",
    ).dropDuplicates()


def sale_rows(bronze: DataFrame) -> DataFrame:
    """Price rows: one per station, product, day and price."""
    return bronze.select(
        clean_identifier(F.col(IDENTIFIER)).alias("cnpj"),
        "produto",
        "valor_de_venda",
        "valor_de_compra",
        "unidade_de_medida",
        DAY,
    ).where(F.col(DAY).isNotNull()).dropDuplicates()


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by `order`: one aggregate with partial maxima, no sort.

    Ties on `order` are settled by the other columns, so the answer is the same on every run.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.max(F.struct(*order, *rest)).alias("_row")
    return df.groupBy(*keys).agg(packed).select(*keys, "_row.*").select(*df.columns)


def latest_stations(stations: DataFrame) -> DataFrame:
    """The newest register row of every station."""
    return latest_per_key(stations, ["cnpj"], [DAY])


def monthly_prices(sales: DataFrame, stations: DataFrame) -> DataFrame:
    """Mean sale price and row count by product, region and month, with subtotals."""
    regions = latest_stations(stations).select("cnpj", "regiao_sigla")
    monthly = sales.groupBy("cnpj", "produto", F.trunc(DAY, "month").alias("month")).agg(
        F.sum(F.col("valor_de_venda").cast("double")).alias("total"),
        F.count("valor_de_venda").alias("priced"),
    )
    return (
        monthly.join(regions, "cnpj", "left")
        .rollup("produto", "regiao_sigla", "month")
        .agg((F.sum("total") / F.nullif(F.sum("priced"), F.lit(0))).alias("mean_price"),
             F.sum("priced").alias("priced"))
    )


@dataclass(frozen=True)
class LayerConfig:
    """Where the layers are, and how long replaced versions stay."""

    landing: str
    bronze: str
    stations: str
    sales: str
    retention_hours: float = RETENTION_HOURS


def _publish(table: LayerTable, rows: DataFrame, retention: float, allow_new_schema: bool) -> None:
    table.overwrite(rows, allow_new_schema=allow_new_schema)
    table.compact()
    table.expire(retention)


def run_layers(spark: SparkSession, config: LayerConfig) -> bool:
    """Landing to bronze to both silver tables; stops quietly when nothing has landed."""
    landed = read_delimited(spark, config.landing)
    if landed is None:
        return False
    bronze = LayerTable(spark, config.bronze)
    _publish(bronze, bronze_rows(landed), config.retention_hours, allow_new_schema=False)
    rows = bronze.read()
    if rows.isEmpty():
        return False
    for path, build in ((config.stations, station_rows), (config.sales, sale_rows)):
        _publish(LayerTable(spark, path), build(rows), config.retention_hours, allow_new_schema=True)
    return True


def landed_from_orders(t: Tables) -> DataFrame:
    """Landing-shaped text rows made from orders, customers and nations, with bad cells among them."""
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    orders = orders.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    code = reduce(
        lambda out, pair: out.when(F.col("n_regionkey") == pair[0], pair[1]),
        enumerate(["N", "NE", "S", "SE"]),
        F.when(F.col("n_regionkey") == 99, "CO"),
    ).otherwise("XX")
    day = F.when(F.col("o_orderkey") % 97 == 0, F.lit("bad")).when(
        F.col("o_orderkey") % 89 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")
    ).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    price = comma_text(F.col("o_totalprice"))
    digits = F.lpad(F.col("c_custkey").cast("string"), 8, "0")
    return orders.select(
        code.alias("Regiao - Sigla"),
        F.col("n_name").alias("Estado - Sigla"),
        F.concat(F.lit("CITY "), F.col("c_nationkey").cast("string")).alias("Municipio"),
        F.col("c_name").alias("Revenda"),
        F.concat_ws(
            "", F.lit(" "), F.substring(digits, 1, 2), F.lit("."), F.substring(digits, 3, 3), F.lit("."),
            F.substring(digits, 6, 3), F.lit("/0001-90 "),
        ).alias("CNPJ da Revenda"),
        F.concat(F.lit("STREET "), F.col("c_mktsegment")).alias("Nome da Rua"),
        F.when(F.col("c_custkey") % 5 == 0, "S/N").when(F.col("c_custkey") % 5 == 1, "1,234")
        .otherwise(F.col("c_custkey").cast("string")).alias("Numero Rua"),
        F.lit(None).cast("string").alias("Complemento"),
        F.col("c_mktsegment").alias("Bairro"),
        F.concat(F.substring(digits, 1, 5), F.lit("-"), F.substring(digits, 6, 3)).alias("Cep"),
        F.col("o_orderpriority").alias("Produto"),
        day.alias("Data da Coleta"),
        F.when(F.col("o_orderkey") % 83 == 0, F.concat(F.lit("1."), price)).otherwise(price).alias("Valor de Venda"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("")).otherwise(price).alias("Valor de Compra"),
        F.lit("R$ / litro").alias("Unidade de Medida"),
        F.col("o_orderstatus").alias("Bandeira"),
    )


_LANDED_SQL = """
WITH landed AS (
  SELECT CASE n_regionkey WHEN 0 THEN 'N' WHEN 1 THEN 'NE' WHEN 2 THEN 'S' WHEN 3 THEN 'SE' ELSE 'XX' END AS code,
         n_name, c_nationkey, c_name, c_custkey, c_mktsegment, o_orderpriority, o_orderstatus, o_orderkey,
         CASE WHEN o_orderkey % 97 = 0 OR o_orderkey % 89 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day,
         CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE CAST(o_totalprice AS FLOAT) END AS sale,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_totalprice AS FLOAT) END AS bought,
         lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS digits
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
), kept AS (SELECT * FROM landed WHERE day IS NOT NULL)
"""


@case("q_bronze_job", _LANDED_SQL + """
SELECT code AS regiao_sigla, n_name AS estado_sigla, c_name AS revenda, digits || '000190' AS cnpj_da_revenda,
       digits AS cep, o_orderpriority AS produto, CAST(day AS VARCHAR) AS data_da_coleta,
       round(CAST(sale AS DOUBLE), 3) AS valor_de_venda, round(CAST(bought AS DOUBLE), 3) AS valor_de_compra
FROM kept""")
def bronze_job(t: Tables) -> DataFrame:
    return bronze_rows(landed_from_orders(t)).select(
        "regiao_sigla", "estado_sigla", "revenda", "cnpj_da_revenda", "cep", "produto",
        F.col(DAY).cast("string").alias(DAY),
        *[F.round(F.col(p).cast("double"), 3).alias(p) for p in PRICES],
    )


@case("q_bronze_reject_reasons", _LANDED_SQL + """
SELECT CASE WHEN day IS NULL AND sale IS NULL THEN 'bad day,bad valor_de_venda'
            WHEN day IS NULL THEN 'bad day' ELSE 'bad valor_de_venda' END AS why, count(*) AS n
FROM landed WHERE day IS NULL OR sale IS NULL GROUP BY 1""")
def bronze_reject_reasons(t: Tables) -> DataFrame:
    return (
        bronze_rejects(landed_from_orders(t))
        .groupBy(F.array_join("reasons", ",").alias("why")).agg(F.count("*").alias("n"))
    )


_STATION_COLUMNS = """CASE code WHEN 'N' THEN 'Norte' WHEN 'NE' THEN 'Nordeste' WHEN 'S' THEN 'Sul'
            WHEN 'SE' THEN 'Sudeste' END AS regiao_sigla,
       n_name AS estado_sigla, 'CITY ' || c_nationkey AS municipio, c_name AS nome_posto,
       digits || '000190' AS cnpj,
       CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 1234 ELSE CAST(c_custkey AS INTEGER) END AS numero_rua,
       digits AS cep"""


@case("q_station_job", _LANDED_SQL + f"""
SELECT DISTINCT {_STATION_COLUMNS}, CAST(day AS VARCHAR) AS data_da_coleta, o_orderstatus AS bandeira
FROM kept""")
def station_job(t: Tables) -> DataFrame:
    return station_rows(bronze_rows(landed_from_orders(t))).select(
        "regiao_sigla", "estado_sigla", "municipio", "nome_posto", "cnpj", "numero_rua", "cep",
        F.col(DAY).cast("string").alias(DAY), "bandeira",
    )


@case("q_station_latest", _LANDED_SQL + f"""
SELECT {_STATION_COLUMNS}, CAST(max(day) AS VARCHAR) AS data_da_coleta FROM kept GROUP BY ALL""")
def station_latest(t: Tables) -> DataFrame:
    return latest_stations(station_rows(bronze_rows(landed_from_orders(t)))).select(
        "regiao_sigla", "estado_sigla", "municipio", "nome_posto", "cnpj", "numero_rua", "cep",
        F.col(DAY).cast("string").alias(DAY),
    )


_SALES_SQL = _LANDED_SQL + """, sales AS (
  SELECT DISTINCT digits || '000190' AS cnpj, o_orderpriority AS produto, sale, bought, day FROM kept)
"""


@case("q_sales_job", _SALES_SQL + """
SELECT cnpj, produto, round(CAST(sale AS DOUBLE), 3) AS valor_de_venda,
       round(CAST(bought AS DOUBLE), 3) AS valor_de_compra, CAST(day AS VARCHAR) AS data_da_coleta FROM sales""")
def sales_job(t: Tables) -> DataFrame:
    return sale_rows(bronze_rows(landed_from_orders(t))).select(
        "cnpj", "produto", *[F.round(F.col(p).cast("double"), 3).alias(p) for p in PRICES],
        F.col(DAY).cast("string").alias(DAY),
    )


@case("q_sales_by_month", _SALES_SQL + """, regions AS (
  SELECT DISTINCT digits || '000190' AS cnpj, CASE code WHEN 'N' THEN 'Norte' WHEN 'NE' THEN 'Nordeste'
         WHEN 'S' THEN 'Sul' WHEN 'SE' THEN 'Sudeste' END AS regiao_sigla FROM kept)
SELECT produto, regiao_sigla, CAST(CAST(date_trunc('month', day) AS DATE) AS VARCHAR) AS month,
       round(avg(CAST(sale AS DOUBLE)), 2) AS mean_price, count(sale) AS priced
FROM sales JOIN regions USING (cnpj) GROUP BY ROLLUP (produto, regiao_sigla, CAST(CAST(date_trunc('month', day) AS DATE) AS VARCHAR))
""")
def sales_by_month(t: Tables) -> DataFrame:
    bronze = bronze_rows(landed_from_orders(t))
    out = monthly_prices(sale_rows(bronze), station_rows(bronze))
    return out.select(
        "produto", "regiao_sigla", F.col("month").cast("string").alias("month"),
        F.round("mean_price", 2).alias("mean_price"), "priced",
    )


@case("q_flagship_region_month", """
WITH cleaned AS (
  SELECT DISTINCT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS FLOAT) AS price,
         CASE r_regionkey WHEN 0 THEN 'South' WHEN 1 THEN 'West' WHEN 2 THEN 'East' WHEN 3 THEN 'North' END AS area
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT area, strftime(day, '%Y-%m') AS month, round(sum(CAST(price AS DOUBLE)), 1) AS total, count(*) AS n
FROM cleaned GROUP BY 1, 2""")
def flagship_region_month(t: Tables) -> DataFrame:
    areas = {0: "South", 1: "West", 2: "East", 3: "North"}
    text = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "o_orderkey", "r_regionkey",
            comma_text(F.col("o_totalprice")).alias("price"),
            F.date_format("o_orderdate", "dd/MM/yyyy").alias("day"),
        )
    )
    cleaned = text.select(
        "o_orderkey",
        label_of(F.col("r_regionkey"), areas).alias("area"),
        parse_day(F.col("day")).alias("day"),
        parse_number(F.col("price")).alias("price"),
    ).dropDuplicates()
    return cleaned.groupBy("area", F.date_format("day", "yyyy-MM").alias("month")).agg(
        F.round(F.sum(F.col("price").cast("double")), 1).alias("total"), F.count("*").alias("n")
    )
