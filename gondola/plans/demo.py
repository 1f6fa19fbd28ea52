"""A catalogue made from the star-schema tables, in SQL that Spark and DuckDB both read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gondola.sources.shared import dealt

_P = "CAST(p_partkey AS STRING)"
_NINE = f"lpad({_P}, 9, '0')"
TEMPLATES = {
    "fabricantes": "SELECT concat('fab_', CAST(r_regionkey AS STRING)) AS id, r_name AS nome FROM {region}",
    "marcas": "SELECT concat('marca_', CAST(n_nationkey AS STRING)) AS id, concat('fab_', CAST(n_regionkey AS STRING)) AS fabricante_id, n_name AS nome FROM {nation}",
    "produtos": f"""SELECT concat('prod_', {_P}) AS id, concat('marca_', CAST(p_partkey % 27 AS STRING)) AS marca_id,
      CASE WHEN p_partkey % 11 = 3 THEN NULL WHEN p_partkey % 11 = 5 THEN concat(p_name, ' [object Object]') ELSE p_name END AS descricao_padronizada,
      p_name AS descricao_original, p_type AS classe,
      CASE WHEN p_partkey % 3 = 0 THEN 'Congelado' WHEN p_partkey % 3 = 1 THEN 'Resfriado' ELSE 'Temperatura Ambiente' END AS conservacao,
      CASE WHEN p_partkey % 13 = 0 THEN CAST(-5 AS BIGINT) WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(p_size * 100 AS BIGINT) END AS peso_gramas,
      p_partkey % 5 = 0 AS fracionado,
      CASE WHEN p_partkey % 6 = 0 THEN NULL WHEN p_partkey % 6 = 1 THEN concat('https://cdn.example.com/', {_P}, '.webp')
        WHEN p_partkey % 6 = 2 THEN concat('/imagens/', {_P}, '.webp') WHEN p_partkey % 6 = 3 THEN 'https://x.force.com/placeholder.png'
        WHEN p_partkey % 6 = 4 THEN concat('foto', {_P}, '.webp') ELSE concat('https://files.example.org/storage/', {_P}) END AS imagem_url,
      CASE WHEN p_partkey % 4 = 0 THEN 'aprovado' WHEN p_partkey % 4 = 1 THEN 'pendente_aprovacao' WHEN p_partkey % 4 = 2 THEN 'sem_imagem' END AS status_imagem,
      p_partkey AS ordinal FROM {{part}}""",
    "codigos": f"""SELECT concat('cb_sku_', {_P}) AS id, concat('prod_', {_P}) AS produto_id, 'SKU' AS tipo,
      CASE WHEN p_partkey % 17 = 0 THEN concat('abc', {_P}) ELSE {_P} END AS codigo, 3 * p_partkey AS ordinal FROM {{part}} WHERE p_partkey % 10 <> 9
    UNION ALL SELECT concat('cb_ean_', {_P}), concat('prod_', {_P}), 'EAN',
      CASE WHEN p_partkey % 8 = 0 THEN concat('789', {_NINE}) WHEN p_partkey % 8 = 1 THEN concat('0789', {_NINE})
        WHEN p_partkey % 8 = 2 THEN concat('789', lpad(CAST(p_partkey - p_partkey % 16 AS STRING), 9, '0'), '5')
        WHEN p_partkey % 8 = 3 THEN concat('x', {_P}) WHEN p_partkey % 8 = 4 THEN lpad({_P}, 5, '0')
        WHEN p_partkey % 8 = 5 THEN concat('1789', lpad({_P}, 10, '0')) ELSE concat('790', lpad({_P}, 10, '0')) END, 3 * p_partkey + 1
      FROM {{part}} WHERE p_partkey % 12 <> 7
    UNION ALL SELECT concat('cb_dun_', {_P}), concat('prod_', {_P}), 'DUN-14',
      CASE WHEN p_partkey % 2 = 0 THEN concat('1789', lpad({_P}, 10, '0')) ELSE concat('789', {_NINE}) END, 3 * p_partkey + 2
      FROM {{part}} WHERE p_partkey % 3 = 0""",
    # an earlier state of the products
    "antes": f"""SELECT concat('prod_', {_P}) AS id, concat('marca_', CAST((p_partkey + CASE WHEN p_partkey % 10 = 4 THEN 1 ELSE 0 END) % 27 AS STRING)) AS marca_id,
      CASE WHEN p_partkey % 4 = 1 THEN concat(p_name, ' old') ELSE concat(' ', p_name) END AS descricao_padronizada, p_name AS descricao_original,
      CASE WHEN p_partkey % 9 = 2 THEN NULL ELSE p_type END AS classe, 'Congelado' AS conservacao,
      CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE CAST(p_size * 100 AS BIGINT) END AS peso_gramas, p_partkey % 10 = 0 AS fracionado,
      CASE WHEN p_partkey % 2 = 0 THEN '' ELSE concat('https://cdn.example.com/', {_P}, '.webp') END AS imagem_url,
      CASE WHEN p_partkey % 6 = 0 THEN 'aprovado' WHEN p_partkey % 6 = 1 THEN 'reprovado' WHEN p_partkey % 6 = 2 THEN '' ELSE 'sem_imagem' END AS status_imagem,
      p_partkey AS ordinal FROM {{part}} WHERE p_partkey % 7 <> 1""",
    # raw titles with every weight shape
    "titulos": f"""SELECT p_partkey AS id, concat(CASE WHEN p_partkey % 5 = 0 THEN 'FILE DE ' WHEN p_partkey % 5 = 1 THEN 'linguica com ' WHEN p_partkey % 5 = 2 THEN 'CONTRA-FILE e '
        WHEN p_partkey % 5 = 3 THEN '(pesar) PEITO a ' ELSE 'iqf ' END, upper(p_name), CASE WHEN p_partkey % 9 = 0 THEN concat(' ', CAST(p_size AS STRING), 'KG')
        WHEN p_partkey % 9 = 1 THEN concat(' ', CAST(p_size AS STRING), ',5 kg') WHEN p_partkey % 9 = 2 THEN concat(' ', CAST(p_size AS STRING), '0g')
        WHEN p_partkey % 9 = 3 THEN concat(' 2 x ', CAST(p_size AS STRING), ',5kg') WHEN p_partkey % 9 = 4 THEN concat(' ', CAST(p_size AS STRING), ' L')
        WHEN p_partkey % 9 = 5 THEN concat(' ', CAST(p_size AS STRING), '0ml') WHEN p_partkey % 9 = 6 THEN ' peso variavel' WHEN p_partkey % 9 = 7 THEN ' FRACIONADA' ELSE '' END) AS title,
      CASE WHEN p_partkey % 4 = 0 THEN CAST(p_size * 37 AS BIGINT) END AS grams, CASE WHEN p_partkey % 6 = 0 THEN true WHEN p_partkey % 6 = 1 THEN false END AS fractional FROM {{part}}""",
    # titles with brand and class words
    "rotulos": """SELECT p_partkey AS id, CASE WHEN p_partkey % 6 = 0 THEN 'SADIA' WHEN p_partkey % 6 = 1 THEN '' WHEN p_partkey % 6 = 2 THEN p_brand WHEN p_partkey % 6 = 3 THEN NULL WHEN p_partkey % 6 = 4 THEN ' Nobreza ' ELSE 'Lar' END AS marca,
      concat(CASE WHEN p_partkey % 7 = 0 THEN 'Pizza Seara Gourmet ' WHEN p_partkey % 7 = 1 THEN 'Corte retangular ' WHEN p_partkey % 7 = 2 THEN 'Lasanha Bolonhesa ' WHEN p_partkey % 7 = 3 THEN 'Frango Copacol Agro '
        WHEN p_partkey % 7 = 4 THEN 'Lombo Swift congelado ' WHEN p_partkey % 7 = 5 THEN 'Manteiga em lata ' ELSE 'Salmao fresco ' END, p_name) AS title, p_type AS classe FROM {part}""",
}
SOURCES = {"fabricantes": ["region"], "marcas": ["nation"]}


#: Tables whose texts cost much a row: their rows are dealt to all tasks first, for a small file is one task's scan.
DEALT = {"titulos": "p_partkey", "rotulos": "p_partkey"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sources = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in SOURCES.get(name, ["part"])}
    if name in DEALT:
        sources = {t: dealt(rows, DEALT[name]) for t, rows in sources.items()}
    return spark.sql(TEMPLATES[name], **sources)


def cte(*names: str) -> str:
    """WITH clause that defines the named tables for DuckDB."""
    plain = {t: t for t in ("region", "nation", "part")}
    return "WITH " + ",\n".join(f"{n} AS ({TEMPLATES[n].format(**plain)})" for n in names) + "\n"
