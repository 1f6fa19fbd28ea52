"""Registered queries of the scalar libraries, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.dictionaries import ACCENTS, ACRONYMS, BRANDS, CLASSES, CONNECTIVES, CONSERVATION, FRIBOI, KEY_NAMESPACE, NOUNS, SANITISE_IMAGES, TYPOS
from gondola.functions import barcode, classify, keys, text, web
from gondola.plans.demo import cte, table


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sum(code: str, n: int) -> str:
    """SQL for the weighted digit sum of a code."""
    first = 3 if n == 13 else 1
    return " + ".join(f"CAST(substr({code}, {i}, 1) AS INTEGER) * {first if i % 2 else 4 - first}" for i in range(1, n + 1))


MACROS = {
    "digit12": f"(10 - ({_sum('{0}', 12)}) % 10) % 10",
    "digit13": f"(10 - ({_sum('{0}', 13)}) % 10) % 10",
}


def _with_check(code: str, n: int) -> str:
    return f"concat({code}, CAST({MACROS[f'digit{n}'].format(code)} AS VARCHAR))"


CODES_SQL = f"""{cte("codigos")},
c0 AS (SELECT id, codigo, tipo, regexp_replace(codigo, '[^0-9]', '', 'g') AS d FROM codigos),
c1 AS (SELECT *, CASE WHEN length(d) = 13 AND (d LIKE '0789%' OR d LIKE '0790%') THEN substr(d, 2) ELSE d END AS e FROM c0),
c2 AS (SELECT *, CASE WHEN length(e) > 13 AND e LIKE '0%' AND length(ltrim(e, '0')) IN (12, 13) THEN ltrim(e, '0') ELSE e END AS f FROM c1),
c3 AS (SELECT *, CASE WHEN length(f) < 12 THEN lpad(f, 12, '0') ELSE f END AS g, CASE WHEN length(e) < 12 THEN lpad(e, 12, '0') ELSE e END AS h FROM c2),
c4 AS (SELECT *, CASE WHEN d = '' THEN NULL WHEN length(g) = 12 THEN {_with_check("g", 12)} ELSE substr(g, 1, 13) END AS ean,
  CASE WHEN length(h) = 12 THEN {_with_check("h", 12)} ELSE h END AS ean_table FROM c3),
c5 AS (SELECT *, concat('1', substr(ean, 1, 12)) AS b FROM c4)
"""


def barcode_normalise(spark, sf_dir):
    c = table(spark, sf_dir, "codigos")
    ean = barcode.ean13(F.col("codigo"))
    return c.withColumn("ean", ean).select("id", "ean", barcode.ean13_of_table(F.col("codigo")).alias("ean_table"), barcode.dun14(F.col("codigo"), F.col("ean")).alias("dun"))


BARCODE_SQL = f"""{CODES_SQL} SELECT id, ean, ean_table, CASE WHEN length(d) = 14 THEN d WHEN length(d) = 13 THEN {_with_check("d", 13)}
 WHEN length(ean) = 13 THEN {_with_check("b", 13)} END AS dun FROM c5"""


def ean_conformity(spark, sf_dir):
    """Share of codes that are 13 long after normalisation, by the length they came with."""
    c = table(spark, sf_dir, "codigos").where("tipo = 'EAN'")
    conforming = F.count_if(F.length(barcode.ean13(F.col("codigo"))) == 13)
    rows = c.groupBy(F.length("codigo").cast("long").alias("given_length")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.length("codigo") == 13).alias("conforming_before"), conforming.alias("conforming_after")
    )
    return rows.withColumn("pct_before", F.round(F.try_divide(F.col("conforming_before") * 100.0, F.col("total")), 2).cast("double"))


CONFORMITY_SQL = f"""{CODES_SQL} SELECT CAST(length(codigo) AS BIGINT) AS given_length, count(*) AS total, count(*) FILTER (length(codigo) = 13) AS conforming_before,
 count(*) FILTER (length(ean) = 13) AS conforming_after, round(CAST(count(*) FILTER (length(codigo) = 13) * 100.0 AS DOUBLE) / count(*), 2) AS pct_before
 FROM c5 WHERE tipo = 'EAN' GROUP BY 1"""


def code_tests(spark, sf_dir):
    c = table(spark, sf_dir, "codigos")
    code = F.col("codigo")
    return c.select("id", barcode.is_digits(code).alias("numeric"), barcode.has_digits(code, 13).alias("thirteen"), barcode.has_digits(code, 14).alias("fourteen"), code.rlike("^([0-9]{13,14}|prod_.*|[0-9a-f]{8}-.*)$").alias("file_name"))


CODE_TESTS_SQL = f"""{cte("codigos")} SELECT id, regexp_matches(trim(codigo), '^[0-9]+$') AS numeric, regexp_matches(codigo, '^[0-9]{{13}}$') AS thirteen,
 regexp_matches(codigo, '^[0-9]{{14}}$') AS fourteen, regexp_matches(codigo, '^([0-9]{{13,14}}|prod_.*|[0-9a-f]{{8}}-.*)$') AS file_name FROM codigos"""


def uuid_keys(spark, sf_dir):
    p = table(spark, sf_dir, "produtos")
    uid = keys.uuid5(F.col("id"))
    return p.withColumn("key", uid).select("id", "key", keys.uuid5(F.col("marca_id")).alias("parent_key"), keys.uuid5(F.col("key")).alias("again"))


def _uuid_sql(name: str) -> str:
    h = f"sha1(unhex('{KEY_NAMESPACE.replace('-', '')}') || encode({name}))"
    nibble = f"substr('89ab', (strpos('0123456789abcdef', substr({h}, 17, 1)) - 1) % 4 + 1, 1)"
    return f"concat(substr({h}, 1, 8), '-', substr({h}, 9, 4), '-5', substr({h}, 14, 3), '-', {nibble}, substr({h}, 18, 3), '-', substr({h}, 21, 12))"


UUID_SQL = f"""{cte("produtos")} SELECT id, {_uuid_sql("id")} AS key, {_uuid_sql("marca_id")} AS parent_key, {_uuid_sql("id")} AS again FROM produtos"""


def title_case(spark, sf_dir):
    return table(spark, sf_dir, "titulos").select("id", text.title_case(F.col("title")).alias("title"))


_ACCENT_ROWS = ", ".join(f"('{k}', '{v}')" for k, v in ACCENTS.items())
TITLE_CTE = f""",
accents AS (SELECT * FROM (VALUES {_ACCENT_ROWS}) t(k, v)),
words AS (SELECT id, unnest(string_split(regexp_replace(trim(title), '\\s+', ' ', 'g'), ' ')) AS w, generate_subscripts(string_split(regexp_replace(trim(title), '\\s+', ' ', 'g'), ' '), 1) AS i FROM titulos),
cored AS (SELECT *, regexp_extract(w, '^[(\\["'']+') AS lead, regexp_extract(w, '[)\\].,"'':;!?]+$') AS trail FROM words),
core AS (SELECT *, substr(w, length(lead) + 1, greatest(length(w) - length(lead) - length(trail), 0)) AS c FROM cored),
parts AS (SELECT id, i, unnest(string_split(c, '-')) AS p, generate_subscripts(string_split(c, '-'), 1) AS j FROM core),
joined AS (SELECT id, i, string_agg(coalesce(v, CASE WHEN j > 1 AND lower(p) IN ({_quoted(CONNECTIVES)}) THEN lower(p) ELSE concat(upper(substr(p, 1, 1)), lower(substr(p, 2))) END), '-' ORDER BY j) AS hyphened
  FROM parts LEFT JOIN accents ON k = lower(p) GROUP BY id, i),
cased AS (SELECT core.id, core.i, CASE WHEN regexp_matches(lower(w), '^[0-9]+([.,][0-9]+)?(kg|g)$') THEN lower(w) WHEN upper(w) IN ({_quoted(ACRONYMS)}) THEN upper(w) WHEN c = '' THEN w
  ELSE concat(lead, CASE WHEN v IS NOT NULL THEN v WHEN core.i > 1 AND lower(c) IN ({_quoted(CONNECTIVES)}) THEN lower(c) WHEN substr(c, 2) LIKE '%-%' THEN hyphened ELSE concat(upper(substr(c, 1, 1)), lower(substr(c, 2))) END, trail) END AS t
  FROM core JOIN joined ON core.id = joined.id AND core.i = joined.i LEFT JOIN accents ON k = lower(c)),
clean AS (SELECT id, string_agg(t, ' ' ORDER BY i) AS title FROM cased GROUP BY id)
"""
TITLE_SQL = f"{cte('titulos')}{TITLE_CTE} SELECT id, title FROM clean"

_NUM = "([0-9]+(?:[.,][0-9]+)?)"
WEIGHT_CTE = f""",
found AS (SELECT id, title, grams AS known, fractional AS given, lower(title) AS s,
  regexp_extract(lower(title), '([0-9]+)\\s*x\\s*{_NUM}\\s*(kg|g|l|ml)\\b', 1) AS times, replace(regexp_extract(lower(title), '([0-9]+)\\s*x\\s*{_NUM}\\s*(kg|g|l|ml)\\b', 2), ',', '.') AS each,
  regexp_extract(lower(title), '([0-9]+)\\s*x\\s*{_NUM}\\s*(kg|g|l|ml)\\b', 3) AS unit,
  regexp_extract(lower(title), '{_NUM}\\s*l\\b', 1) AS l, regexp_extract(lower(title), '{_NUM}\\s*ml\\b', 1) AS ml, regexp_extract(lower(title), '{_NUM}\\s*kg\\b', 1) AS kg, regexp_extract(lower(title), '{_NUM}\\s*g\\b', 1) AS g FROM titulos),
picked AS (SELECT *, CASE WHEN regexp_matches(s, '\\b(peso\\s+vari[aá]vel|a\\s+granel)\\b') OR (regexp_matches(s, '\\bpesar\\b') AND NOT regexp_matches(s, '\\b{_NUM}\\s*(kg|g|l|ml)\\b')) THEN 'open'
  WHEN times <> '' THEN 'pack' WHEN l <> '' AND NOT regexp_matches(s, 'lingui[cç]a') THEN 'l' WHEN ml <> '' THEN 'ml' WHEN kg <> '' THEN 'kg' WHEN g <> '' THEN 'g' ELSE 'none' END AS kind FROM found),
weighed AS (SELECT *, CASE kind WHEN 'pack' THEN CAST(floor(CAST(times AS DOUBLE) * CAST(each AS DOUBLE) * CASE WHEN unit IN ('kg', 'l') THEN 1000 ELSE 1 END + 0.5) AS BIGINT)
  WHEN 'l' THEN CAST(floor(CAST(replace(l, ',', '.') AS DOUBLE) * 1000 + 0.5) AS BIGINT) WHEN 'ml' THEN CAST(floor(CAST(replace(ml, ',', '.') AS DOUBLE) + 0.5) AS BIGINT)
  WHEN 'kg' THEN CAST(floor(CAST(replace(kg, ',', '.') AS DOUBLE) * 1000 + 0.5) AS BIGINT) WHEN 'g' THEN CAST(floor(CAST(replace(g, ',', '.') AS DOUBLE) + 0.5) AS BIGINT) END AS grams,
  CASE kind WHEN 'pack' THEN concat(times, 'x', CASE WHEN each LIKE '%.%' THEN rtrim(rtrim(each, '0'), '.') ELSE each END, unit) WHEN 'l' THEN concat(l, 'l') WHEN 'ml' THEN concat(ml, 'ml') WHEN 'kg' THEN concat(kg, 'kg') WHEN 'g' THEN concat(g, 'g') END AS label,
  kind IN ('open', 'none') AS fractional FROM picked)
"""


def weight_extract(spark, sf_dir):
    t = table(spark, sf_dir, "titulos").select("id", "title", text.weight(F.col("title")).alias("w"))
    # numbers that may be missing are shown as text: engines differ in how a frame holds them
    grams, supplied = F.col("w.grams").cast("string"), text.supplier_grams(F.col("title")).cast("string")
    return t.select("id", grams.alias("grams"), F.col("w.fractional").alias("fractional"), F.col("w.label").alias("label"), text.weight_token(F.col("title")).alias("token"), supplied.alias("supplier_grams"))


WEIGHT_SQL = f"""{cte("titulos")}{WEIGHT_CTE} SELECT id, CAST(grams AS VARCHAR) AS grams, fractional, label,
 nullif(replace(regexp_replace(regexp_extract(s, '\\b([0-9]+(?:[.,][0-9]+)?\\s*(?:g|kg|ml|l))\\b', 1), '\\s+', '', 'g'), ',', '.'), '') AS token,
 CAST(CAST(floor(CAST(nullif(replace(regexp_extract(s, '([0-9]+[.,]?[0-9]*)\\s*(kg|g)\\b', 1), ',', '.'), '') AS DOUBLE) * CASE WHEN regexp_extract(s, '([0-9]+[.,]?[0-9]*)\\s*(kg|g)\\b', 2) = 'kg' THEN 1000 ELSE 1 END + 0.5) AS BIGINT) AS VARCHAR) AS supplier_grams
 FROM weighed"""


def description_format(spark, sf_dir):
    t = table(spark, sf_dir, "titulos")
    t = t.withColumns(text.described(F.col("title"), F.col("grams"), F.col("fractional")))
    return t.select("id", text.description(F.col("_clean"), F.col("_parsed")).alias("description"), F.col("_parsed.grams").cast("string").alias("grams"), F.col("_parsed.fractional").alias("fractional"))


DESCRIPTION_SQL = f"""{cte("titulos")}{TITLE_CTE}{WEIGHT_CTE},
filled AS (SELECT weighed.id, clean.title, CASE WHEN fill THEN known ELSE grams END AS grams, CASE WHEN fill THEN false WHEN given THEN true WHEN NOT given AND grams IS NOT NULL THEN false ELSE fractional END AS fractional,
  CASE WHEN fill THEN CASE WHEN known >= 1000 THEN concat(replace(rtrim(rtrim(printf('%.3f', known / 1000.0), '0'), '.'), '.', ','), 'kg') ELSE concat(known, 'g') END ELSE label END AS label
  FROM (SELECT *, coalesce(grams IS NULL AND known > 0 AND NOT coalesce(given, false), false) AS fill FROM weighed) weighed JOIN clean ON weighed.id = clean.id),
bare AS (SELECT *, trim(regexp_replace(title, '\\s*\\(pesar\\)', '', 'gi')) AS b, regexp_replace(label, '[^0-9.,]', '', 'g') AS n, regexp_replace(label, '[0-9.,]', '', 'g') AS u FROM filled)
SELECT id, CASE WHEN fractional OR grams IS NULL THEN CASE WHEN regexp_matches(lower(title), '\\(pesar\\)') THEN title ELSE concat(trim(regexp_replace(title, '\\s+fracionad[oa]', '', 'gi')), ' (pesar)') END
 WHEN regexp_matches(b, concat('(?i)\\b', regexp_replace(n, '\\.', '[.,]'), '\\s*', u, '\\b')) THEN b ELSE concat(b, ' ', label) END AS description, CAST(grams AS VARCHAR) AS grams, fractional FROM bare"""


def text_cleanups(spark, sf_dir):
    t = table(spark, sf_dir, "titulos")
    raw = F.concat(F.lit("Sadia - "), F.col("title"), F.lit(" talsicha congelada (12)"))
    return t.select(
        "id",
        text.repair_typos(raw).alias("repaired"),
        text.drop_conservation(raw).alias("unconserved"),
        text.plain_words(raw).alias("plain"),
        text.strip_brand(raw, ["Sadia", "Perdigao"]).alias("unbranded"),
        text.drop_trailing_number(raw).alias("unnumbered"),
        text.slugify(raw).alias("slug"),
        text.safe_id(raw).alias("safe"),
        text.sheet_name(raw).alias("sheet"),
        text.base_name(F.concat(F.lit("/a/b."), F.col("id"), F.lit(".webp"))).alias("file"),
        text.weight_label(F.coalesce("grams", F.lit(0))).alias("shown"),
    )


def _typos_sql(x: str) -> str:
    for a, b in TYPOS.items():
        x = f"regexp_replace({x}, '{a}', '{b}', 'gi')"
    return x


CLEANUP_SQL = f"""{cte("titulos")}, raw AS (SELECT id, grams, concat('Sadia - ', title, ' talsicha congelada (12)') AS r FROM titulos)
SELECT id, {_typos_sql("trim(r)")} AS repaired,
 trim(regexp_replace(regexp_replace(r, '\\s*[•\\-/,]?\\s*(congelada|congelado|resfriada|resfriado)\\b', '', 'gi'), '\\s+', ' ', 'g')) AS unconserved,
 trim(regexp_replace(regexp_replace(strip_accents(lower(r)), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS plain,
 trim(regexp_replace(r, '^(Sadia|Perdigao)\\s*[-|]\\s*', '', 'i')) AS unbranded, trim(regexp_replace(r, '\\s*\\([0-9]+\\)\\s*$', '')) AS unnumbered,
 regexp_replace(regexp_replace(lower(r), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug, regexp_replace(r, '[^a-zA-Z0-9_-]', '_', 'g') AS safe,
 substr(regexp_replace(r, '[\\\\/?*\\[\\]:]', '_', 'g'), 1, 31) AS sheet, concat('b.', id) AS file,
 CASE WHEN coalesce(grams, 0) >= 1000 THEN concat(replace(rtrim(rtrim(printf('%.3f', grams / 1000.0), '0'), '.'), '.', ','), 'kg') ELSE concat(coalesce(grams, 0), 'g') END AS shown FROM raw"""


def noun_tags(spark, sf_dir):
    t = table(spark, sf_dir, "rotulos")
    return t.select("id", F.explode(text.noun_tags(F.concat(F.col("title"), F.lit(" nuggets de peito")))).alias("tag"))


_NOUN_ROWS = ", ".join(f"('{g}', '{n}')" for g, ns in NOUNS.items() for n in ns)
NOUN_SQL = f"""{cte("rotulos")} SELECT DISTINCT id, g AS tag FROM rotulos, (VALUES {_NOUN_ROWS}) t(g, n)
 WHERE contains(regexp_replace(strip_accents(lower(concat(title, ' nuggets de peito'))), '[^a-z0-9\\s]', ' ', 'g'), n)"""


def classify_brand(spark, sf_dir):
    t = table(spark, sf_dir, "rotulos").withColumn("b", classify.brand(F.col("marca"), F.col("title")))
    return t.select("id", F.col("b.id").alias("marca_id"), F.col("b.nome").alias("nome"), F.col("b.fabricante_id").alias("fabricante_id"), classify.compatible(F.col("marca"), F.lit("Aurora")).alias("with_aurora"))


_BRAND_ROWS = ", ".join(f"('{k}', '{n}', '{s}', '{h}')" for k, (n, s, h) in BRANDS.items())
BRAND_SQL = f"""{cte("rotulos")}, brands AS (SELECT * FROM (VALUES {_BRAND_ROWS}) t(k, nome, slug, holding)),
low AS (SELECT *, trim(lower(coalesce(marca, ''))) AS m, trim(lower(title)) AS t FROM rotulos),
hits AS (SELECT low.id, arg_max(brands, length(k) * 2 + CASE WHEN regexp_matches(k, '^[0-9]+$') THEN 1 ELSE 0 END) AS b FROM low JOIN brands ON regexp_matches(t, concat('(?:^|[^a-z0-9à-ÿ])', k, '(?:$|[^a-z0-9à-ÿ])')) GROUP BY low.id),
made AS (SELECT low.id, marca, m, coalesce(e.slug, hits.b.slug, CASE WHEN coalesce(marca, '') = '' THEN 'brf' ELSE regexp_replace(regexp_replace(lower(marca), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') END) AS slug,
  coalesce(e.nome, hits.b.nome, CASE WHEN coalesce(marca, '') = '' THEN 'BRF' ELSE marca END) AS nome, coalesce(e.holding, hits.b.holding, '{FRIBOI}') AS fabricante_id, e.holding AS own
  FROM low LEFT JOIN brands e ON e.k = m LEFT JOIN hits ON hits.id = low.id)
SELECT id, concat('marca_', slug) AS marca_id, nome, fabricante_id, coalesce(marca, '') <> '' AND coalesce(own, '{FRIBOI}') = 'fab_aurora_cooperativa' AS with_aurora FROM made"""


def classify_product(spark, sf_dir):
    t = table(spark, sf_dir, "rotulos")
    args = [F.col("title"), F.col("classe"), F.lit("")]
    return t.select("id", classify.product_class(*args).alias("classe"), classify.conservation(*args).alias("conservacao"))


def _cases(rows) -> str:
    return " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{c}'" for c, p in rows)


CLASS_SQL = f"""{cte("rotulos")}, low AS (SELECT *, lower(concat(title, ' ', classe, ' ')) AS t FROM rotulos)
SELECT id, CASE {_cases(CLASSES)} ELSE concat(upper(substr(classe, 1, 1)), lower(substr(classe, 2))) END AS classe, CASE {_cases(CONSERVATION)} ELSE 'Resfriado' END AS conservacao FROM low"""


def url_functions(spark, sf_dir):
    p = _read(spark, sf_dir, "pages")
    image = F.when(F.col("page_id") % 3 == 0, F.lit("//c.example/x.png")).when(F.col("page_id") % 3 == 1, F.lit("/i/x.png")).otherwise(F.lit("x.png"))
    return p.select(
        "page_id",
        web.host(F.col("url")).alias("host"),
        web.origin(F.col("url")).alias("origin"),
        web.absolute(image, F.col("url")).alias("image"),
        web.store_url(F.concat(F.lit("/f?x=1"), F.col("page_id"), F.lit("&height=3&width=4")), "https://d.example").alias("stored"),
        web.origin_class(F.col("url"), ["example.org"]).alias("kind"),
        web.usable_image(F.col("url"), SANITISE_IMAGES).alias("usable"),
    )


_ORIGIN = "regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1)"
URL_SQL = f"""SELECT page_id, lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)', 1)) AS host, {_ORIGIN} AS origin,
 CASE page_id % 3 WHEN 0 THEN 'https://c.example/x.png' WHEN 1 THEN concat({_ORIGIN}, '/i/x.png') ELSE concat({_ORIGIN}, '/x.png') END AS image,
 concat('https://d.example/f?x=1', page_id) AS stored, CASE WHEN url LIKE '%example.org%' THEN 'storage' ELSE 'web' END AS kind,
 NOT ({" OR ".join(f"contains(lower(url), '{p}')" for p in SANITISE_IMAGES)}) AS usable FROM pages"""


def html_extract(spark, sf_dir):
    p = _read(spark, sf_dir, "pages")
    shop = web.shop_page(F.col("html"), F.col("url"))
    trade = web.trade_page(F.concat(F.col("html"), F.lit('EAN13: 7891164027759 "post_id": '), F.col("page_id")), F.col("url"))
    return p.select("page_id", shop.alias("s"), trade.alias("t")).select("page_id", F.col("s.title").alias("shop_title"), F.col("s.ean").alias("shop_ean"), F.col("t.sku").alias("trade_sku"), F.col("t.ean").alias("trade_ean"), F.col("t.conservacao").alias("conservacao"))


HTML_SQL = """WITH h AS (SELECT page_id, html, trim(replace(regexp_replace(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), '<[^>]+>', '', 'g'), '&#8211;', '-')) AS t FROM pages WHERE html LIKE '%<h1%')
SELECT page_id, trim(regexp_replace(t, '\\s*-\\s*Seara\\s*$', '', 'i')) AS shop_title, regexp_extract(html, '\\b((?:789|790)[0-9]{10})\\b', 1) AS shop_ean, CAST(page_id AS VARCHAR) AS trade_sku, '7891164027759' AS trade_ean,
 CASE WHEN contains(html, 'Congelado') OR contains(t, 'Congelad') THEN 'Congelado' ELSE 'Resfriado' END AS conservacao FROM h"""


def brand_page_extract(spark, sf_dir):
    p = _read(spark, sf_dir, "pages")
    head = F.concat(F.lit('<meta property="og:title" content="Sadia - Item '), F.col("page_id"), F.lit('"><figure class="photo-product"><img src="/f/'), F.col("page_id"), F.lit('.png"></figure>'))
    page = web.brand_page(F.concat(head, F.col("html"), F.lit(" 7891164027759 ")), F.col("url"), ["Sadia", "Perdigao"])
    looked = web.gtin_page(F.concat(F.lit('<meta property="og:image" content="https://i.example/'), F.col("page_id"), F.lit('.jpg">'), F.col("html")))
    return p.select("page_id", page.alias("b"), looked.alias("g")).select("page_id", F.col("b.title").alias("title"), F.col("b.image_url").alias("image_url"), F.col("b.ean").alias("ean"), F.col("g.image_url").alias("gtin_image"))


BRAND_PAGE_SQL = f"""SELECT page_id, concat('Item ', page_id) AS title, concat({_ORIGIN}, '/f/', page_id, '.png') AS image_url, '7891164027759' AS ean, concat('https://i.example/', page_id, '.jpg') AS gtin_image FROM pages"""


def sitemap_scan(spark, sf_dir):
    p = _read(spark, sf_dir, "part").select("p_partkey")
    k = F.col("p_partkey").cast("string")
    xml = F.concat(F.lit("<urlset><url><loc><![CDATA[https://a.example/produtos/x/"), k, F.lit("]]></loc></url><url><loc>https://a.example/p/"), k, F.lit("</loc><image:loc>https://a.example/i.png</image:loc></url></urlset>"))
    return p.select(
        "p_partkey",
        F.array_join(web.sitemap_keys(xml), ",").alias("keys"),
        F.array_join(web.sitemap_products(xml), ",").alias("products"),
        F.size(web.sitemap_entries(xml)).cast("long").alias("entries"),
        F.try_element_at(web.sitemap_entries(xml), F.lit(-1))["image_url"].alias("image"),
    )


SITEMAP_SQL = """SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS keys, concat('https://a.example/produtos/x/', p_partkey) AS products, CAST(1 AS BIGINT) AS entries, 'https://a.example/i.png' AS image FROM part"""


def json_lookup(spark, sf_dir):
    e = _read(spark, sf_dir, "events")
    parsed = F.from_json("props", "k long, x_ean string, missing string")
    return e.select("event_id", parsed["k"].alias("k"), F.coalesce(parsed["x_ean"], parsed["missing"], F.get_json_object("props", "$.k")).alias("code"))


JSON_SQL = "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS code FROM events"


def image_choice(spark, sf_dir):
    p = _read(spark, sf_dir, "part")
    k = F.col("p_partkey").cast("string")
    candidates = F.array(F.lit(None).cast("string"), F.concat(F.lit("/file/banner/products/"), k, F.lit("_00_x.jpg")), F.concat(F.lit("/file/products/"), k, F.lit("_02.jpg")), F.concat(F.lit("/file/products/"), k, F.lit("_01_"), F.regexp_replace(F.lower(F.split("p_name", " ")[0]), "[^a-z0-9]", ""), F.lit(".png&height=1&width=2")))
    return p.select("p_partkey", web.best_image(candidates, k, F.col("p_name"), "https://d.example").alias("image"))


IMAGE_SQL = """SELECT p_partkey, CASE WHEN length(w) <> 0 THEN concat('https://d.example/file/products/', p_partkey, '_01_', w, '.png') END AS image
 FROM (SELECT p_partkey, regexp_replace(lower(string_split(p_name, ' ')[1]), '[^a-z0-9]', '', 'g') AS w FROM part)"""

QUERIES = {
    "ean_conformity": (ean_conformity, CONFORMITY_SQL),
    "barcode_normalise": (barcode_normalise, BARCODE_SQL),
    "code_tests": (code_tests, CODE_TESTS_SQL),
    "uuid_keys": (uuid_keys, UUID_SQL),
    "title_case": (title_case, TITLE_SQL),
    "weight_extract": (weight_extract, WEIGHT_SQL),
    "description_format": (description_format, DESCRIPTION_SQL),
    "text_cleanups": (text_cleanups, CLEANUP_SQL),
    "noun_tags": (noun_tags, NOUN_SQL),
    "classify_brand": (classify_brand, BRAND_SQL),
    "classify_product": (classify_product, CLASS_SQL),
    "url_functions": (url_functions, URL_SQL),
    "html_extract": (html_extract, HTML_SQL),
    "brand_page_extract": (brand_page_extract, BRAND_PAGE_SQL),
    "sitemap_scan": (sitemap_scan, SITEMAP_SQL),
    "json_lookup": (json_lookup, JSON_SQL),
    "image_choice": (image_choice, IMAGE_SQL),
}
