"""Addresses, HTML attributes and sitemaps as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gondola.dictionaries import STORE_IMAGES
from gondola.functions.text import END, START, slugify, strip_brand, text_or


def first(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null if there is none or it is empty."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def contains_any(text: Column, parts: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in parts])


def drop_tags(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.regexp_replace(text, "<[^>]+>", ""), "&#8211;", "-"))


def origin(url: Column) -> Column:
    return first(url, "^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)")


def host(url: Column) -> Column:
    """Host name; null where the address can't be read."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def absolute(url: Column, page: Column) -> Column:
    return (
        F.when(url.startswith("//"), F.concat(F.lit("https:"), url))
        .when(url.startswith("/"), F.concat(origin(page), url))
        .when(~url.rlike("^https?://"), F.concat(origin(page), F.lit("/"), url))
        .otherwise(url)
    )


def store_url(url: Column, domain: str) -> Column:
    """Without size parameters, with the domain in front unless it has one."""
    bare = F.regexp_replace(url, "&height=[0-9]+&width=[0-9]+", "")
    return F.when(bare.startswith("http"), bare).otherwise(F.concat(F.lit(domain), bare))


def origin_class(url: Column, storage: list[str]) -> Column:
    u = F.btrim(F.coalesce(url, F.lit("")))
    return (
        F.when(u == "", F.lit("empty"))
        .when(contains_any(u, storage), F.lit("storage"))
        .when(u.rlike("^https?://"), F.lit("web"))
        .when(u.startswith("/"), F.lit("relative"))
        .otherwise(F.lit("file"))
    )


def first_barcode(text: Column) -> Column:
    return first(text, rf"{START}((?:789|790)[0-9]{{10}}){END}")


def usable_image(url: Column, parts: list[str]) -> Column:
    """Not missing, not a null word, and free of the given parts."""
    low = F.btrim(F.lower(F.coalesce(url, F.lit(""))))
    return ~(low.isin("", "n/a", "null", "undefined") | contains_any(low, parts))


# Fixed patterns: the portals' file names and markup, here and in the page functions below.
_STORE_IMAGE = r"/products/([0-9]+)_(00|01)(?:_([a-z0-9-]+))?\.(jpg|jpeg|png|webp)"


def store_image(url: Column, sku: Column, title: Column) -> Column:
    """Whether an image is a packshot of this very product: no banned part, file pattern, same SKU, a shared word."""
    low = F.btrim(F.lower(F.coalesce(url, F.lit(""))))
    slug = F.regexp_extract(low, _STORE_IMAGE, 3)
    long_ = lambda words: F.filter(words, lambda w: F.length(w) > 2)
    plain = F.translate(F.lower(F.coalesce(title, F.lit(""))), "àáâãäçèéêëìíîïñòóôõöùúûü", "aaaaaceeeeiiiinooooouuuu")
    mine, theirs = long_(F.split(plain, "[^A-Za-z0-9_]+")), long_(F.split(slug, "-"))
    shared = F.exists(theirs, lambda s: F.exists(mine, lambda t: t.contains(s) | s.contains(t)))
    judged = (slug != "") & (F.coalesce(title, F.lit("")) != "") & (F.size(theirs) > 0)
    same = (F.coalesce(sku, F.lit("")) == "") | (F.regexp_extract(low, _STORE_IMAGE, 1) == sku)
    return (low != "") & ~contains_any(low, STORE_IMAGES) & low.rlike(_STORE_IMAGE) & same & (~judged | shared)


def best_image(candidates: Column, sku: Column, title: Column, domain: str) -> Column:
    """The first usable one of an array of addresses."""
    full = F.transform(F.filter(candidates, lambda u: F.coalesce(u, F.lit("")) != ""), lambda u: store_url(u, domain))
    return F.try_element_at(F.filter(full, lambda u: store_image(u, sku, title)), F.lit(1))


def brand_page(html: Column, url: Column, brands: list[str]) -> Column:
    """struct(title, image_url, ean) of an institutional page; null without title or image."""
    title = strip_brand(text_or(first(html, r"""(?i)<meta\s+property=["']og:title["']\s+content=["']([^"']+)["']"""), first(html, r"(?i)<title>([^<]+)</title>")), brands)
    shared = first(html, r"""(?i)<meta\s+property=["']og:image["']\s+content=["']([^"']+)["']""")
    image = F.coalesce(
        first(html, r"""(?is)<figure[^>]*class=["'][^"']*(?:photo-product|product-pack|product-photo|product-image)[^"']*["'][^>]*>.*?<img[^>]*src=["']([^"']+)["']"""),
        first(html, r"""(?i)<img[^>]*src=["']([^"']*(?:/products/|/product/|assets/images/_/products/)[^"']+)["']"""),
        first(html, r"""(?i)<img[^>]*alt=["'][^"']*imagem do produto:[^"']*["'][^>]*src=["']([^"']+)["']"""),
        F.when(~contains_any(shared, ["/storage/product/files/", "share.jpg", "logo"]), shared),
    )
    ean = first(html, rf"{START}(789[0-9]{{10}}){END}")
    made = F.struct(title.alias("title"), absolute(image, url).alias("image_url"), ean.alias("ean"))
    return F.when((F.coalesce(title, F.lit("")) != "") & image.isNotNull(), made)


def _cold(html: Column, title: Column) -> Column:
    return F.when(html.contains("Congelado") | title.contains("Congelad"), F.lit("Congelado")).otherwise(F.lit("Resfriado"))


def trade_page(html: Column, url: Column) -> Column:
    """struct of a trade portal's product page; null without a heading."""
    title = drop_tags(first(html, r"(?s)<h1[^>]*>(.*?)</h1>"))
    number = lambda found, n: F.when(F.regexp_replace(found, r"[.\s]", "").rlike(f"^[0-9]{{{n}}}$"), F.regexp_replace(found, r"[.\s]", ""))
    ean = F.coalesce(
        first(html, r"(?i)<strong>\s*EAN13?\s*</strong>\s*:\s*([0-9.\s]+)"),
        first(html, r"(?i)EAN13?\s*:\s*([0-9.\s]+)"),
        first(html, r"""(?i)data-(?:dl-)?product_ean=["']\s*([0-9]{13})\s*["']"""),
        first_barcode(html),
    )
    dun = F.coalesce(
        first(html, r"(?i)<strong>\s*DUN14?\s*</strong>\s*:\s*([0-9.\s]+)"), first(html, r"(?i)DUN14?\s*:\s*([0-9.\s]+)"), first(html, rf"{START}([12789][0-9]{{13}}){END}")
    )
    sku = F.coalesce(first(html, r'"post_id"\s*:\s*([0-9]+)'), first(url, "/produto/([^/]+)"), slugify(title))
    made = F.struct(
        sku.alias("sku"),
        title.alias("title"),
        F.coalesce(number(ean, 13), F.lit("")).alias("ean"),
        F.coalesce(number(dun, 14), F.lit("")).alias("dun"),
        F.coalesce(first(html, r'"marca"\s*:\s*\["([^"]+)"\]'), F.lit("Seara")).alias("marca"),
        F.coalesce(first(html, r'"category"\s*:\s*\["([^"]+)"\]'), F.lit("Aves")).alias("classe"),
        _cold(html, title).alias("conservacao"),
        F.coalesce(first(html, r'(?i)<img[^>]+src="([^"]*searafoodsolutions\.com\.br/files/[^"]+)"'), F.lit("")).alias("image_url"),
    )
    return F.when(F.coalesce(title, F.lit("")) != "", made)


def shop_page(html: Column, url: Column) -> Column:
    """struct of a consumer shop's product page; null without a title."""
    title = F.btrim(F.regexp_replace(drop_tags(F.coalesce(first(html, r"(?s)<h1[^>]*>(.*?)</h1>"), first(html, r"(?s)<title>(.*?)</title>"))), r"(?i)\s*-\s*Seara\s*$", ""))
    uploaded = first(html, r'(?i)<img[^>]+src="([^"]*seara\.com\.br/wp-content/uploads/[^"]+)"')
    image = F.coalesce(first(html, r'(?i)data-product-image="([^"]+)"'), F.when(~contains_any(uploaded, ["Logo", "icon", "svg"]), uploaded), F.lit(""))
    ean = F.coalesce(first(html, r"""(?i)data-ean=["']\s*([0-9]{13})\s*["']"""), first(html, r"""(?i)data-dl-product_ean=["']\s*([0-9]{13})\s*["']"""), first_barcode(html), F.lit(""))
    made = F.struct(
        F.concat(F.lit("seara_b2c_"), F.coalesce(first(url, "/produto/([^/]+)"), slugify(title))).alias("sku"),
        title.alias("title"),
        ean.alias("ean"),
        _cold(html, title).alias("conservacao"),
        image.alias("image_url"),
    )
    return F.when(F.coalesce(title, F.lit("")) != "", made)


def gtin_page(html: Column) -> Column:
    """struct(image_url, title) of a lookup page; null without a real image."""
    image = F.btrim(
        F.coalesce(
            first(html, r'(?i)meta\s+property="og:image"\s+content="([^"]+)"'),
            first(html, r'(?i)meta\s+name="og:image"\s+content="([^"]+)"'),
            first(html, r'(?i)<img[^>]+id="product_gallery_image"[^>]+src="([^"]+)"'),
            first(html, r'(?i)<img[^>]+class="product-image"[^>]+src="([^"]+)"'),
        )
    )
    title = F.coalesce(first(html, r'(?is)<h1[^>]*class="product-title"[^>]*>(.*?)</h1>'), first(html, r'(?i)meta\s+property="og:title"\s+content="([^"]+)"'), F.lit(""))
    made = F.struct(image.alias("image_url"), F.btrim(F.regexp_replace(title, "<[^>]+>", "")).alias("title"))
    return F.when((image != "") & ~contains_any(image, ["no-image", "missing"]), made)


def sitemap_locations(xml: Column) -> Column:
    """All <loc> values, CDATA unwrapped."""
    found = F.regexp_extract_all(xml, F.lit(r"(?s)<loc>\s*(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?\s*</loc>"), F.lit(1))
    return F.transform(found, lambda u: F.btrim(u))


def sitemap_addresses(xml: Column) -> Column:
    """The locations that are web addresses."""
    return F.filter(sitemap_locations(xml), lambda u: u.startswith("http"))


def sitemap_keys(xml: Column) -> Column:
    """Distinct all-digit last path parts."""
    last = F.transform(sitemap_locations(xml), lambda u: F.regexp_extract(u, "([^/]*)/?$", 1))
    return F.array_distinct(F.filter(last, lambda k: k.rlike("^[0-9]+$")))


def sitemap_products(xml: Column, least_parts: int = 4) -> Column:
    """Addresses under /produtos/ with enough path parts."""
    deep = lambda u: F.size(F.filter(F.split(u, "/"), lambda p: p != "")) >= least_parts
    return F.filter(sitemap_locations(xml), lambda u: u.contains("/produtos/") & deep(u))


def sitemap_entries(xml: Column) -> Column:
    """Array of (url, image_url) of each <url> block."""
    blocks = F.slice(F.split(xml, "<url>"), 2, 1 << 30)
    one = lambda b: F.struct(first(b, "<loc>([^<]+)</loc>").alias("url"), F.coalesce(first(b, "<image:loc>([^<]+)</image:loc>"), F.lit("")).alias("image_url"))
    return F.filter(F.transform(blocks, one), lambda e: e["url"].isNotNull())
