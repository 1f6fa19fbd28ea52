"""Small relational scenarios, sources, sinks and the snapshot stream."""

import json

from pyspark.sql import functions as F

from gondola.functions import text
from gondola.operators import audit, cdc, dedup, export, match, merge, reports
from gondola.plans.sync import sync
from gondola.sources import readers, writers
from gondola.streaming import snapshots


def test_codes_of_file(spark):
    codes = spark.createDataFrame([("a", 0, "1", "p", "EAN", "7"), ("a", 1, "2", "q", None, " 7 "), ("a", 2, "3", "q", "EAN", " "), ("b", 0, "4", "q", "EAN", "7")], "file string, ordinal long, id string, produto_id string, tipo string, codigo string")
    kept, lost = dedup.codes_of_file(codes)
    assert {r["id"] for r in kept.collect()} == {"1", "4"}
    assert [(r["id"], r["tipo"]) for r in lost.collect()] == [("2", "DESCONHECIDO")]
    owned = merge.upsert_codes(codes.select("id", "produto_id", "codigo").limit(0), kept)
    assert [r["id"] for r in owned.collect()] == ["4"]


def test_reviewed_images_and_changes(spark):
    schema = "id string, marca_id string, descricao_padronizada string, classe string, conservacao string, peso_gramas long, fracionado boolean, imagem_url string, status_imagem string"
    stored = spark.createDataFrame([("1", "m", "d", "c", "x", None, False, "old", "reprovado")], schema)
    incoming = spark.createDataFrame([("1", "m", " d ", "c", None, 5, None, "new", "aprovado")], schema)
    kept = merge.keep_reviewed_images(incoming, stored).first()
    assert (kept["imagem_url"], kept["status_imagem"]) == ("old", "reprovado")
    changes = {c["campo"]: (c["de"], c["para"]) for c in cdc.field_changes(incoming, stored).first()["alteracoes"]}
    assert changes == {"Imagem (URL)": ("old", "new"), "Status da Imagem": ("reprovado", "aprovado"), "Conservação": ("x", "N/D"), "Peso (g)": ("N/D", "5")}


def test_code_kinds(spark):
    rows = [("12345678901234", "EAN"), ("123456789012", "DUN"), ("1234567890123", "EAN"), ("1234567890123", "SKU"), ("12", "EAN"), ("", "EAN"), (None, None)]
    got = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, c string, t string").select("i", export.code_kind(F.col("c"), F.col("t")).alias("k")).orderBy("i").collect()
    assert [r["k"] for r in got] == ["DUN", None, "EAN", "SKU", "SKU", None, None]


def test_band_join_equals_brute_force(spark):
    points = spark.createDataFrame([(i, i % 3, i * 0.37) for i in range(60)], "p long, g long, v double")
    marks = spark.createDataFrame([(i, i % 3, i * 1.1) for i in range(20)], "m long, g long, w double")
    got = {(r["p"], r["m"]) for r in match.band_join(points, marks, ["g"], F.col("w"), F.col("w") + 2.0, F.col("v"), 2.0).collect()}
    assert got == {(p, m) for p in range(60) for m in range(20) if p % 3 == m % 3 and m * 1.1 < p * 0.37 < m * 1.1 + 2.0}


def test_image_match_prefers_the_sku(spark):
    products = spark.createDataFrame([("1", "77", "Peito de Frango 1kg"), ("2", "9", "Peito de Frango 1kg")], "id string, sku string, title string")
    images = spark.createDataFrame([("https://a/produto/peito-de-frango-1kg/", "https://a/i/x.png", 0), ("https://a/produto/queijo/", "https://a/i/z_77.png", 1), ("https://a/produto/peito-de-frango-2kg/", "https://a/i/y.png", 2)], "url string, image_url string, ordinal long")
    got = {r["id"]: r["image_url"] for r in match.image_match(products, images).collect()}
    assert got == {"1": "https://a/i/z_77.png", "2": "https://a/i/x.png"}


def test_repair_drops_the_odd_form(spark):
    from gondola.functions.barcode import ean13_of_table

    codes = spark.createDataFrame([("1", "EAN", "789116402775"), ("2", "EAN", "7891164027759"), ("3", "EAN", "626"), ("4", "SKU", "626")], "id string, tipo string, codigo string")
    got = {r["id"]: r["codigo"] for r in merge.repair_codes(codes, ean13_of_table).collect()}
    assert got == {"2": "7891164027759", "3": "0000000006262", "4": "626"}


def test_empty_tables(spark):
    p = spark.createDataFrame([], "id string, descricao_padronizada string, peso_gramas long, imagem_url string, status_imagem string")
    c = spark.createDataFrame([], "id string, produto_id string, tipo string, codigo string, ordinal long")
    assert audit.audit(p, c).count() == 0
    assert all(d.count() == 0 for d in audit.sanitise(p, c))
    assert reports.barcode_population(p, c).first()["products"] == 0


def test_staging_round_trip(spark, tmp_path):
    doc = {
        "fabricantes": [{"id": "fab_x", "nome": "X"}],
        "marcas": [{"id": "marca_x", "fabricante_id": "fab_x", "nome": "X"}, {"id": "marca_y", "fabricante_id": "fab_x", "nome": "Y"}],
        "produtos": [
            {"id": "prod_1", "marca_id": "marca_x", "descricao_padronizada": "FILE 1KG", "descricao_original": "o", "classe": "c", "conservacao": "Congelado", "fracionado": False},
            {"id": "prod_2", "marca_id": "marca_y", "descricao_padronizada": "SEM CODIGO", "descricao_original": "o", "classe": "c", "conservacao": "Congelado", "fracionado": False},
        ],
        "codigos_barras": [{"id": "cb_1", "produto_id": "prod_1", "tipo": "ean-13", "codigo": "7891164027759"}, {"id": "cb_2", "produto_id": "prod_2", "tipo": "EAN", "codigo": "abc"}],
    }
    (tmp_path / "x_staging.json").write_text(json.dumps(doc))
    staged = readers.staging(spark, f"{tmp_path}/*_staging.json")
    none = lambda df: df.drop("file", "ordinal").limit(0)
    out = sync(staged, none(staged.products), none(staged.brands), none(staged.codes))
    product = out.products.first()
    assert (product["descricao_padronizada"], product["peso_gramas"], product["fracionado"]) == ("Filé 1kg", 1000, False)
    assert [r["nome"] for r in out.brands.collect()] == ["X"]
    assert [(r["tipo"], r["codigo"]) for r in out.codes.collect()] == [("EAN", "7891164027759")]
    assert out.new.first()["ean"] == "7891164027759" and out.changed.count() == 0
    writers.write_tables(str(tmp_path / "out"), marcas=out.brands, produtos=out.products)
    assert spark.read.parquet(str(tmp_path / "out/produtos")).count() == 1
    writers.write_sheets(out.products, "classe", str(tmp_path / "xl"))
    assert spark.read.csv(str(tmp_path / "xl/summary"), header=True).first()["n"] == "1"
    assert readers.first_available(spark, "a int", lambda: spark.read.parquet(str(tmp_path / "no"))).count() == 0


def test_snapshot_stream_equals_batch(spark, tmp_path):
    schema = "id long, v string, n long"
    source, store, check = (str(tmp_path / x) for x in ("in", "store", "check"))
    first = spark.createDataFrame([(1, "a", 0), (2, "b", 1), (1, "c", 2)], schema)
    later = spark.createDataFrame([(2, "d", 3), (3, "e", 4)], schema)
    for batch in (first, later):
        batch.coalesce(1).write.mode("append").parquet(source)
        snapshots.merge_stream(spark.readStream.schema(schema).parquet(source), store, check, "id", ["n"]).awaitTermination(120)
    got = {r["id"]: r["v"] for r in snapshots.current(spark, store, schema).collect()}
    assert got == {1: "c", 2: "d", 3: "e"}


def test_duplicates_name_their_first_owner(spark):
    rows = [(k, f"c{k}", f"p{k}", "SKU", code) for k, code in enumerate([" 1 ", None, "1", "", "2", None, "1"])]
    c = spark.createDataFrame(rows, "ordinal long, id string, produto_id string, tipo string, codigo string")
    p = spark.createDataFrame([], "id string, descricao_padronizada string, descricao_original string, peso_gramas long")
    found = {r["item_id"]: r["details"] for r in audit.audit(p, c).where("category = 'CODIGO_DUPLICADO'").collect()}
    assert set(found) == {"c2", "c6", "c3", "c5"}
    assert found["c6"].endswith("produto p6 e produto p0.") and found["c5"].endswith("produto p5 e produto p1.")


def test_numbers_do_not_depend_on_stretches(spark):
    rows = spark.createDataFrame([(k * 7 % 101, "a" if k % 3 else None) for k in range(101)], "o long, g string")
    runs = [sorted(map(tuple, reports.numbered(rows, F.col("g"), "o", "n", step).collect()), key=repr) for step in (1, 10, 1000)]
    assert runs[0] == runs[1] == runs[2]
    assert sorted(n for _, g, n in runs[0] if g is None) == list(range(1, 35))


def test_words_lose_every_accent(spark):
    df = spark.createDataFrame([("Pa\u0303o ÁÇÃO ＡＢ² ě ß",)], "t string")
    assert df.select(text.plain_words(F.col("t")).alias("t")).first()["t"] == "pao acao ab2 e"
