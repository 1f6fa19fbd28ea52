"""Registered queries over made-up pages and sitemaps in every form that the page functions tell apart; a part is a page.

Each form is chosen by the part's key, so the SQL says what must be found without reading markup.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola.functions import web

_EAN = "concat('789', lpad(CAST(p_partkey AS STRING), 10, '0'))"
_DUN = "concat('1789', lpad(CAST(p_partkey AS STRING), 10, '0'))"


def _pages(spark, sf_dir, html: str, url: str = "concat('https://a.example/p/', p_partkey)"):
    return spark.sql(f"SELECT p_partkey, {html} AS html, {url} AS url FROM {{part}}", part=spark.read.parquet(f"{sf_dir}/part.parquet"))


def _form(n: int, *cases: str) -> str:
    """SQL: the case of p_partkey modulo n, the last one for all others."""
    return f"CASE p_partkey % {n} " + " ".join(f"WHEN {k} THEN {c}" for k, c in enumerate(cases[:-1])) + f" ELSE {cases[-1]} END"


def _fields(page, names: list[str]):
    return ["p_partkey", *[F.col(f"{page}.{n}").alias(n) for n in names]]


# institutional pages: title by og:title or <title>; four ways to an image, each before the shared one; an EAN or none
BRAND_HTML = f"""concat({_form(4, """'<title>Other</title><meta property="og:title" content="Sadia - Item '""", """'<meta property=\"og:title\" content=\"Item '""", """'<title>Perdigao | Item '""", "'<p>No title '")}, p_partkey,
 {_form(4, "'\">'", "' | Sadia\">'", "'</title>'", "'</p>'")},
 {_form(7, """concat('<figure class="a photo-product"><b></b><img alt="" src="/f/', p_partkey, '.png"></figure><img src="/products/no.png">')""",
 """concat('<figure class=\"product-image\">\n<img src=\"//c.example/', p_partkey, '.png\"></figure>')""",
 """concat('<figure class=\"other\"><img src=\"https://a.example/x/products/', p_partkey, '.png\"></figure>')""",
 """concat('<img src=\"assets/images/_/products/', p_partkey, '.png\">')""",
 """concat('<img alt="Imagem do produto: x" class="y" src="/alt/', p_partkey, '.png">')""",
 "''", "''")},
 '<meta property="og:image" content="', CASE p_partkey % 7 WHEN 6 THEN '/logo.png' ELSE concat('https://s.example/', p_partkey, '.png') END, '">',
 {_form(5, "''", f"concat('EAN ', {_EAN}, ' .')", f"concat('7', {_EAN})", f"concat('<i data-x=\"', {_EAN}, '\">')", "concat('790', lpad(CAST(p_partkey AS STRING), 10, '0'))")})"""


def brand_pages(spark, sf_dir):
    page = web.brand_page(F.col("html"), F.col("url"), ["Sadia", "Perdigao"])
    return _pages(spark, sf_dir, BRAND_HTML).select("p_partkey", page.alias("b")).select(*_fields("b", ["title", "image_url", "ean"]))


BRAND_SQL = f"""WITH f AS (SELECT p_partkey, p_partkey % 4 <> 3 AND p_partkey % 7 <> 6 AS found FROM part)
SELECT p_partkey, CASE WHEN found THEN concat('Item ', p_partkey) END AS title,
 CASE WHEN found THEN concat({_form(7, "'https://a.example/f/'", "'https://c.example/'", "'https://a.example/x/products/'", "'https://a.example/assets/images/_/products/'", "'https://a.example/alt/'", "'https://s.example/'")}, p_partkey, '.png') END AS image_url,
 CASE WHEN found AND p_partkey % 5 IN (1, 3) THEN {_EAN} END AS ean FROM f"""


# trade pages: sku by post id, address or title; four ways to an EAN and three to a DUN, with and without the right length
TRADE_HTML = f"""concat(CASE WHEN p_partkey % 17 = 0 THEN '<h2>' ELSE '<h1 class="t">' END, 'Produto <b>', p_partkey, '</b>', CASE WHEN p_partkey % 8 = 3 THEN ' Congelada' ELSE '' END, CASE WHEN p_partkey % 17 = 0 THEN '</h2>' ELSE '</h1>' END,
 {_form(3, """concat('"post_id" : ', p_partkey, ',')""", "''", "''")},
 {_form(6, f"concat('<strong> EAN13 </strong>: ', {_EAN}, '<br>')", f"concat('EAN13: ', substr({_EAN}, 1, 6), '.', substr({_EAN}, 7), '<br>')", f"concat('<i data-dl-product_ean=\"', {_EAN}, '\">')", f"concat('code ', {_EAN}, ';')", "'EAN13: 123<br>'", "''")},
 {_form(5, f"concat('<strong>DUN14</strong>: ', {_DUN}, '<br>')", f"concat('DUN14: ', substr({_DUN}, 1, 7), ' ', substr({_DUN}, 8), '<br>')", f"concat('box ', {_DUN}, ';')", "'DUN14: 12<br>'", "''")},
 {_form(2, """'"marca": ["Marca X"]'""", "''")}, {_form(4, """'"category" : ["Suinos"]'""", "''")}, {_form(3, "''", "'<p>Congelado</p>'", "''")},
 {_form(2, "'<img src=\"https://other.example/x.png\">'", """concat('<img alt="" src="https://x.searafoodsolutions.com.br/files/', p_partkey, '.png">')""")})"""
_TRADE = ["sku", "title", "ean", "dun", "marca", "classe", "conservacao", "image_url"]


def trade_pages(spark, sf_dir):
    url = "CASE WHEN p_partkey % 3 = 1 THEN concat('https://a.example/produto/item-', p_partkey, '/x') ELSE 'https://a.example/' END"
    return _pages(spark, sf_dir, TRADE_HTML, url).select("p_partkey", web.trade_page(F.col("html"), F.col("url")).alias("t")).where("t is not null").select(*_fields("t", _TRADE))


TRADE_SQL = f"""SELECT p_partkey, {_form(3, "CAST(p_partkey AS VARCHAR)", "concat('item-', p_partkey)", "concat('produto-', p_partkey, CASE WHEN p_partkey % 8 = 3 THEN '-congelada' ELSE '' END)")} AS sku,
 concat('Produto ', p_partkey, CASE WHEN p_partkey % 8 = 3 THEN ' Congelada' ELSE '' END) AS title, CASE WHEN p_partkey % 6 < 4 THEN {_EAN} ELSE '' END AS ean, CASE WHEN p_partkey % 5 < 3 THEN {_DUN} ELSE '' END AS dun,
 {_form(2, "'Marca X'", "'Seara'")} AS marca, {_form(4, "'Suinos'", "'Aves'")} AS classe, CASE WHEN p_partkey % 3 = 1 OR p_partkey % 8 = 3 THEN 'Congelado' ELSE 'Resfriado' END AS conservacao,
 {_form(2, "''", "concat('https://x.searafoodsolutions.com.br/files/', p_partkey, '.png')")} AS image_url FROM part WHERE p_partkey % 17 <> 0"""


# shop pages: a heading or the title without the shop's name; three ways to an EAN, two to an image
SHOP_HTML = f"""concat({_form(4, "concat('<h1>Lombo ', p_partkey, '</h1>')", "concat('<title>Lombo ', p_partkey, ' - Seara </title>')", "concat('<title>No</title><h1 id=\"x\"><span>Lombo</span> ', p_partkey, ' &#8211; SEARA</h1>')", "'<p>none</p>'")},
 {_form(6, f"concat('<i data-ean=\"', {_EAN}, '\">')", f"concat('<i data-dl-product_ean=\" ', {_EAN}, '\">')", f"concat('code ', {_EAN}, ' ')", "''")},
 {_form(5, """concat('<i data-product-image="/d/', p_partkey, '.png"><img src="https://seara.com.br/wp-content/uploads/no.png">')""", """concat('<img class="z" src="https://seara.com.br/wp-content/uploads/', p_partkey, '.png">')""", "'<img src=\"https://seara.com.br/wp-content/uploads/Logo.png\">'", "'<img src=\"https://seara.com.br/wp-content/uploads/x.svg\">'", "''")})"""


def shop_pages(spark, sf_dir):
    url = "CASE WHEN p_partkey % 2 = 0 THEN concat('https://a.example/produto/lombo-', p_partkey) ELSE 'https://a.example/' END"
    page = web.shop_page(F.col("html"), F.col("url"))
    return _pages(spark, sf_dir, SHOP_HTML, url).select("p_partkey", page.alias("s")).where("s is not null").select(*_fields("s", ["sku", "title", "ean", "conservacao", "image_url"]))


SHOP_SQL = f"""SELECT p_partkey, concat('seara_b2c_lombo-', p_partkey) AS sku, concat('Lombo ', p_partkey) AS title, CASE WHEN p_partkey % 6 < 3 THEN {_EAN} ELSE '' END AS ean, 'Resfriado' AS conservacao,
 {_form(5, "concat('/d/', p_partkey, '.png')", "concat('https://seara.com.br/wp-content/uploads/', p_partkey, '.png')", "''")} AS image_url FROM part WHERE p_partkey % 4 <> 3"""


# lookup pages: four ways to an image, none, or a stand-in; a heading, the shared title, or none
GTIN_HTML = f"""concat({_form(6, """concat('<meta property="og:image" content="https://i.example/', p_partkey, '.jpg"><img class="product-image" src="/no.png">')""", """concat('<meta name=\"og:image\" content=\"https://i.example/', p_partkey, '.jpg\">')""",
 """concat('<img id="product_gallery_image" class="x" src="https://i.example/', p_partkey, '.jpg">')""", """concat('<img class=\"product-image\" src=\"https://i.example/', p_partkey, '.jpg\">')""", "'<meta property=\"og:image\" content=\"https://i.example/no-image.jpg\">'", "'<p></p>'")},
 {_form(3, """concat('<h1 class="product-title"> Found <b>', p_partkey, '</b> </h1><meta property="og:title" content="No">')""", """concat('<meta property=\"og:title\" content=\"Found ', p_partkey, '\">')""", "''")})"""


def gtin_pages(spark, sf_dir):
    return _pages(spark, sf_dir, GTIN_HTML).select("p_partkey", web.gtin_page(F.col("html")).alias("g")).select(*_fields("g", ["image_url", "title"]))


GTIN_SQL = f"""SELECT p_partkey, CASE WHEN p_partkey % 6 < 4 THEN concat('https://i.example/', p_partkey, '.jpg') END AS image_url,
 CASE WHEN p_partkey % 6 < 4 THEN {_form(3, "concat('Found ', p_partkey)", "concat('Found ', p_partkey)", "''")} END AS title FROM part"""


# sitemaps of none to four addresses: plain and in CDATA (which blocks don't read), with an image and without, on the web and not, under /produtos/ and not
SITEMAP_XML = """concat('<urlset>', CASE WHEN p_partkey % 2 = 0 THEN concat('<url><loc>https://a.example/produtos/x/', p_partkey, '</loc><image:image><image:loc>https://a.example/', p_partkey, '.png</image:loc></image:image></url>') ELSE '' END,
 CASE WHEN p_partkey % 3 = 0 THEN concat('<url> <loc> <![CDATA[https://a.example/p/', p_partkey, '/]]> </loc></url>') ELSE '' END,
 CASE WHEN p_partkey % 5 = 0 THEN concat('<url><loc>/produtos/y/', p_partkey, '</loc></url>') ELSE '' END, CASE WHEN p_partkey % 7 = 0 THEN concat('<url><loc>http://a.example/about</loc></url>') ELSE '' END, '</urlset>')"""


def sitemap_forms(spark, sf_dir):
    xml, entries = F.col("html"), web.sitemap_entries(F.col("html"))
    return _pages(spark, sf_dir, SITEMAP_XML).select(
        "p_partkey",
        F.array_join(web.sitemap_addresses(xml), " ").alias("addresses"),
        F.array_join(web.sitemap_keys(xml), " ").alias("keys"),
        F.array_join(web.sitemap_products(xml), " ").alias("products"),
        F.array_join(F.transform(entries, lambda e: F.concat(e["url"], F.lit("|"), F.coalesce(e["image_url"], F.lit("")))), " ").alias("entries"),
    )


_LISTED = lambda *cases: "array_to_string(list_filter([" + ", ".join(f"CASE WHEN p_partkey % {n} = 0 THEN {c} END" for n, c in cases) + "], lambda x: x IS NOT NULL), ' ')"
_X, _P, _Y = "concat('https://a.example/produtos/x/', p_partkey)", "concat('https://a.example/p/', p_partkey, '/')", "concat('/produtos/y/', p_partkey)"
SITEMAP_SQL = f"""SELECT p_partkey, {_LISTED((2, _X), (3, _P), (7, "'http://a.example/about'"))} AS addresses, CASE WHEN p_partkey % 2 = 0 OR p_partkey % 3 = 0 OR p_partkey % 5 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE '' END AS keys,
 {_LISTED((2, _X))} AS products, {_LISTED((2, f"concat({_X}, '|https://a.example/', p_partkey, '.png')"), (5, f"concat({_Y}, '|')"), (7, "'http://a.example/about|'"))} AS entries FROM part"""

QUERIES = {
    "brand_pages": (brand_pages, BRAND_SQL),
    "trade_pages": (trade_pages, TRADE_SQL),
    "shop_pages": (shop_pages, SHOP_SQL),
    "gtin_pages": (gtin_pages, GTIN_SQL),
    "sitemap_forms": (sitemap_forms, SITEMAP_SQL),
}
