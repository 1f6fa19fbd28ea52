"""Golden vectors of the scalar libraries."""

import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gondola.dictionaries import KEY_NAMESPACE
from gondola.functions import barcode, classify, keys, text, web


def evaluate(spark, rows, schema, **columns):
    df = spark.createDataFrame(rows, schema).withColumn("_n", F.monotonically_increasing_id())
    return [tuple(r[c] for c in columns) for r in df.select("_n", *[v.alias(k) for k, v in columns.items()]).orderBy("_n").collect()]


def test_ean13(spark):
    pairs = [
        (None, None), ("", None), ("abc", None), ("626", "0000000006262"), ("0", "0000000000000"), ("789116402775", "7891164027759"),
        ("7891164027759", "7891164027759"), ("7891164027750", "7891164027750"), ("0789116402775", "7891164027759"),
        ("0790123456789", "7901234567891"), ("00789116402775", "7891164027759"), ("007891164027759", "7891164027759"),
        ("17891164027756", "1789116402775"), ("1234567890123456", "1234567890123"),
    ]
    got = evaluate(spark, [(a,) for a, _ in pairs], "c string", e=barcode.ean13(F.col("c")))
    assert [g[0] for g in got] == [b for _, b in pairs]


def test_ean13_is_none_or_13_digits(spark):
    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.text("0123456789 -x", max_size=18), min_size=1, max_size=50))
    def check(codes):
        got = evaluate(spark, [(c,) for c in codes], "c string", e=barcode.ean13(F.col("c")))
        assert all(g is None or len(g) == 13 and g.isdigit() for (g,) in got)

    check()


def test_dun14(spark):
    rows = [(None, None), ("", "7891164027759"), ("17891164027756", None), ("1789116402775", None), ("123", "7891164027759"), ("123", None)]
    got = evaluate(spark, rows, "d string, e string", x=barcode.dun14(F.col("d"), F.col("e")))
    assert [g[0] for g in got] == [None, "17891164027756", "17891164027756", "17891164027756", "17891164027756", None]


def test_uuid5(spark):
    names = ["fab_aurora_cooperativa", "prod_7894904605767", "marca_aurora", "ção", "6a1c57e1-a437-5697-b3d8-05cf5b2a75c1"]
    got = [g[0] for g in evaluate(spark, [(n,) for n in names], "n string", k=keys.uuid5(F.col("n")))]
    assert got[:-1] == [str(uuid.uuid5(uuid.UUID(KEY_NAMESPACE), n)) for n in names[:-1]]
    assert got[0] == "6a1c57e1-a437-5697-b3d8-05cf5b2a75c1" and got[-1] == names[-1]
    with pytest.raises(Exception, match="needs a name"):
        evaluate(spark, [("",)], "n string", k=keys.uuid5(F.col("n")))


def test_title_case(spark):
    pairs = [
        ("FILE DE PEITO DE FRANGO 1KG", "Filé de Peito de Frango 1kg"), ("contra-file BOVINO", "Contra-Filé Bovino"), ("de volta AO LAR", "De Volta Ao Lar"),
        ("LINGUICA • TOSCANA  800G", "Linguiça Toscana 800g"), ("peça iqf (CONGELADA)", "Peça IQF (Congelada)"), ("PRE-COZIDO a MODA-DA-CASA", "Pre-Cozido a Moda-da-Casa"),
        ("", ""), (None, ""), ("()", "()"),
    ]
    got = evaluate(spark, [(a,) for a, _ in pairs], "t string", x=text.title_case(F.col("t")))
    assert [g[0] for g in got] == [b for _, b in pairs]


def test_weight(spark):
    pairs = [
        ("FILE DE PEITO DE FRANGO 1KG", (1000, False, "1kg")), ("LINGUICA TOSCANA 800G", (800, False, "800g")), ("Arroz 2 x 2,5kg", (5000, False, "2x2.5kg")),
        ("12x1L Leite", (12000, False, "12x1l")), ("Leite 1,5 L", (1500, False, "1,5l")), ("Suco 500ml", (500, False, "500ml")), ("Kit 3x100g 1kg", (300, False, "3x100g")),
        ("Carne 1.005kg", (1005, False, "1.005kg")), ("Presunto (pesar) 200g", (200, False, "200g")), ("Picanha a granel", (None, True, None)), ("Picanha (pesar)", (None, True, None)),
        ("Frango peso variável 2kg", (None, True, None)), ("Linguiça 1 L", (None, True, None)), ("Queijo 700 gr", (None, True, None)), ("Caixa 10 UN", (None, True, None)), ("", (None, True, None)), (None, (None, True, None)),
    ]
    got = evaluate(spark, [(a,) for a, _ in pairs], "t string", w=text.weight(F.col("t")))
    assert [tuple(g[0]) for g in got] == [b for _, b in pairs]


def test_description(spark):
    rows = [
        ("FILE DE PEITO 1KG", None, None, "Filé de Peito 1kg"), ("COSTELA BOVINA", None, None, "Costela Bovina (pesar)"), ("COSTELA FRACIONADA", None, None, "Costela (pesar)"),
        ("ARROZ 2 x 2,5KG", None, None, "Arroz 2 X 2,5kg 2x2.5kg"), ("PICANHA", 1200, None, "Picanha 1,2kg"), ("PICANHA", 950, None, "Picanha 950g"), ("PICANHA", 1200, True, "Picanha (pesar)"),
        ("PRESUNTO (pesar)", None, None, "Presunto (Pesar)"), ("PRESUNTO (pesar) 200G", None, None, "Presunto 200g"), ("STEAK 275 G", None, None, "Steak 275 G"), ("SUCO 1,5 L", None, None, "Suco 1,5 L"),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, g long, f boolean, e string")
    df = df.withColumns(text.described(F.col("t"), F.col("g"), F.col("f")))
    got = df.select("i", "e", text.description(F.col("_clean"), F.col("_parsed")).alias("d")).orderBy("i").collect()
    assert [r["d"] for r in got] == [r["e"] for r in got]


def test_brand_and_class(spark):
    rows = [("PERDIGÃO", ""), ("", "Pizza Seara Gourmet 460g"), ("", "Corte retangular"), ("Marca Própria X", ""), (None, "1953 black friboi")]
    got = [g[0] for g in evaluate(spark, rows, "b string, t string", x=classify.brand(F.col("b"), F.col("t")))]
    assert [(g["nome"], g["slug"]) for g in got] == [("Perdigão", "perdigao"), ("Seara Gourmet", "seara-gourmet"), ("BRF", "brf"), ("Marca Própria X", "marca-pr-pria-x"), ("Friboi Black", "friboi-black")]
    rows = [("Lasanha Bolonhesa", ""), ("Frango Copacol", ""), ("Filé de Tilápia Congelado", ""), ("Sardinha em lata", ""), ("Presunto Cozido", ""), ("Picanha", "CORTES")]
    args = [F.col("t"), F.col("c"), F.lit("")]
    got = evaluate(spark, rows, "t string, c string", k=classify.product_class(*args), s=classify.conservation(*args))
    assert got == [("Aves", "Resfriado"), ("Suínos", "Resfriado"), ("Bovinos", "Congelado"), ("Bovinos", "Temperatura Ambiente"), ("Processados", "Resfriado"), ("Cortes", "Resfriado")]


def test_sitemap_and_pages(spark):
    xml = "<url><loc><![CDATA[https://a/produtos/b/12]]></loc><image:loc>i</image:loc></url><url><loc>https://a/x</loc></url>"
    got = evaluate(spark, [(xml,)], "x string", k=web.sitemap_keys(F.col("x")), p=web.sitemap_products(F.col("x")))
    assert got == [(["12"], ["https://a/produtos/b/12"])]
    page = evaluate(spark, [("<p>none</p>",), (None,)], "h string", t=web.trade_page(F.col("h"), F.lit("u")), s=web.shop_page(F.col("h"), F.lit("u")), g=web.gtin_page(F.col("h")))
    assert page == [(None, None, None)] * 2
