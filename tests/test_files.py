"""Every source and sink through files."""

import json

import pytest
from pyspark.sql import functions as F

from gondola import schemas
from gondola.functions import web
from gondola.functions.keys import uuid5
from gondola.functions.text import plain_words
from gondola.sources import readers, tables, workbook, writers


def test_raw_products_of_each_kind(spark, tmp_path):
    names = [f.split()[0] for f in schemas.RAW_PRODUCTS.split(", ")]
    rows = [tuple(f"{n}{k}" for n in names) for k in range(3)]
    df = spark.createDataFrame(rows, schemas.RAW_PRODUCTS)
    df.drop(names[-1]).write.parquet(f"{tmp_path}/p")
    df.write.json(f"{tmp_path}/j")
    df.write.option("header", True).csv(f"{tmp_path}/c")
    want = sorted((*r, "acme") for r in rows)
    assert sorted(map(tuple, readers.raw_products(spark, "acme", f"{tmp_path}/j", "json").collect())) == want
    assert sorted(map(tuple, readers.raw_products(spark, "acme", f"{tmp_path}/c", "csv", header="true").collect())) == want
    assert sorted(map(tuple, readers.raw_products(spark, "acme", f"{tmp_path}/p").collect())) == [(*r[:-2], None, r[-1]) for r in want]


def test_live_rows_before_saved_ones(spark):
    live = spark.createDataFrame([("u1", "a.png"), ("u2", None)], "url string, image_url string")
    saved = spark.createDataFrame([("u1", "old.png"), ("u3", "c.png"), ("u4", ""), ("u5", None)], "url string, image_url string")
    assert sorted(map(tuple, readers.live_with_saved(live, saved).collect()), key=repr) == [("u1", "a.png"), ("u2", None), ("u3", "c.png")]


def test_cached_pages(spark, tmp_path):
    (tmp_path / "www.x.example__p__1.html").write_text("<p>one\ntwo</p>", encoding="utf-8")
    (tmp_path / "note.txt").write_text("no")
    assert [tuple(r) for r in readers.pages(spark, str(tmp_path)).collect()] == [("https://www.x.example/p/1", "<p>one\ntwo</p>")]


def test_catalogue_of_any_layout(spark, tmp_path):
    (tmp_path / "catalogue.json").write_text(json.dumps([{"id": "1", "nome": "é"}, {"id": "2"}], indent=2), encoding="utf-8")
    assert sorted((r["id"], r["nome"]) for r in readers.catalogue_file(spark, f"{tmp_path}/catalogue.json").collect()) == [("1", "é"), ("2", None)]


@pytest.mark.parametrize("read, schema", [(readers.change_log, schemas.CHANGES), (readers.new_product_log, schemas.NEW_PRODUCTS)])
def test_logs_keep_their_schema(spark, tmp_path, read, schema):
    empty = spark.createDataFrame([], schema)
    log = [{f.name: "v" for f in empty.schema.fields if f.dataType.simpleString() == "string"}]
    (tmp_path / "log.json").write_text(json.dumps(log))
    got = read(spark, f"{tmp_path}/log.json")
    assert got.schema.simpleString() == empty.schema.simpleString() and got.count() == 1
    writers.write_log(got, f"{tmp_path}/out")
    writers.write_log(got, f"{tmp_path}/out")  # overwrites
    assert spark.read.schema(schema).json(f"{tmp_path}/out").collect() == got.collect()


def test_manifest_brands(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"holdings": [{"nome": "H", "marcas": ["A", "B"]}, {"nome": "I", "marcas": []}]}))
    assert sorted(map(tuple, readers.manifest_brands(spark, f"{tmp_path}/m.json").collect())) == [("H", "A"), ("H", "B")]


def test_image_listing_reads_no_bytes(spark, tmp_path):
    (tmp_path / "7891.webp").write_bytes(b"x" * 1500)
    (tmp_path / "7892.png").write_bytes(b"x")
    listed = readers.image_files(spark, str(tmp_path))
    assert [(r["path"].rsplit("/", 1)[1], r["length"]) for r in listed.collect()] == [("7891.webp", 1500)] and "content" not in listed.columns


def test_readiness_and_types(spark):
    spark.range(3).createOrReplaceTempView("ready_table")
    assert sorted(map(tuple, readers.readiness(spark, ["ready_table", "no_such_table"]).collect())) == [("no_such_table", "missing", None), ("ready_table", "ready", 3)]
    assert [tuple(r) for r in readers.column_types(spark, "ready_table").collect()] == [("id", "bigint", False)]


def test_uuid_keys_conflicts_and_reports(spark, tmp_path):
    rows = spark.createDataFrame([("prod_1", "x")], "id string, other string")
    assert writers.with_uuid_keys(rows, "id").first()["id"] == rows.select(uuid5(F.col("id")).alias("id")).first()["id"]
    for _ in range(2):
        writers.append_conflicts(rows, f"{tmp_path}/conflicts")
    found = spark.read.json(f"{tmp_path}/conflicts")
    assert found.count() == 2 and set(found.columns) == {"id", "other", "timestamp"}
    assert writers.write_report(rows.limit(0), f"{tmp_path}/report") is False and not (tmp_path / "report").exists()
    assert writers.write_report(rows, f"{tmp_path}/report") is True and spark.read.json(f"{tmp_path}/report").count() == 1


def test_wiped_tables_fill_again(spark, tmp_path):
    tables = {"marcas": spark.createDataFrame([("m",)], "id string"), "produtos": spark.createDataFrame([("p", "m")], "id string, marca_id string")}
    writers.write_tables(str(tmp_path), **tables)
    writers.wipe(tables, str(tmp_path))
    assert all(spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}").count() == 0 for name, df in tables.items())
    writers.write_tables(str(tmp_path), **tables)
    assert all(spark.read.parquet(f"{tmp_path}/{name}").collect() == df.collect() for name, df in tables.items())


def test_manifest_aliases(spark, tmp_path):
    held = [{"id": "h", "nome": "H", "marcas": ["A"], "aliases_scraper": ["run-h"]}]
    (tmp_path / "m.json").write_text(json.dumps({"manifesto_holdings": held, "manifesto_aliases": {"run": "all"}}))
    assert sorted(map(tuple, readers.manifest_aliases(spark, f"{tmp_path}/m.json").collect())) == [("run", "all", None), ("run-h", None, "H")]
    assert [tuple(r) for r in readers.manifest_brands(spark, f"{tmp_path}/m.json").collect()] == [("H", "A")]


def test_workbook(spark, tmp_path):
    products, codes = spark.createDataFrame([("p", "x")], "id string, nome string"), spark.createDataFrame([("c", "p", "1")], "id string, produto_id string, codigo string")
    writers.write_workbook(str(tmp_path), {"Produtos": products, "EAN-DUN": codes})
    assert spark.read.option("header", True).csv(f"{tmp_path}/EAN-DUN").collect() == codes.collect()
    assert spark.read.option("header", True).csv(f"{tmp_path}/Produtos").collect() == products.collect()


@pytest.mark.parametrize("n", [0, 1, 7, 300])
def test_catalogue_parts_make_one_array(spark, tmp_path, n):
    """Read one after the other the parts are the array, ordered; equal rows, nulls and brackets in texts survive."""
    rows = spark.createDataFrame([(f"{k // 2:04}", "x]" if k % 3 else None, f'[{k // 2}, "é"\n') for k in range(n)], "id string, a string, b string").repartition(5)
    writers.write_catalogue(rows, f"{tmp_path}/one", f"{tmp_path}/two")
    for copy in ("one", "two"):
        text = "".join(p.read_text(encoding="utf-8") for p in sorted((tmp_path / copy).glob("part-*")))
        found = json.loads(text)
        assert [r["id"] for r in found] == [f"{k // 2:04}" for k in range(n)] and all(set(r) == {"id", "a", "b"} for r in found)
        assert sorted(map(tuple, readers.catalogue_file(spark, f"{tmp_path}/{copy}", "id string, a string, b string").collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)
    if n > 100:
        assert len(list((tmp_path / "one").glob("part-*"))) > 1


def test_books_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("A", "x & <y> \"z\"", 1, 2.5, None), ("A", " two\nlines\x01 ", None, -1e9, "n"), ("B/é", "0012", 7, None, "")], "book string, name string, n int, v double, empty string")
    book, hidden = F.concat(F.lit("book "), "book"), ("book",)
    sheets = [workbook.sheet(rows, book, 0, F.lit("all"), ["n"], hidden), workbook.sheet(rows, book, 1, F.concat(F.lit("a/very*long[name]: "), F.repeat("book", F.lit(40))), ["n"], hidden), workbook.sheet(rows, book, 2, F.lit("ALL"), ["n"], hidden)]
    for _ in range(2):  # the second replaces the first
        workbook.write_books(sheets, str(tmp_path))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["book A.xlsx", "book B__.xlsx"]
    read = workbook.read_books(spark, str(tmp_path))
    first = workbook.table_of(read.where("sheet = 'all'"), ["name", "n", "v", "empty", "none"])
    assert sorted((tuple(r)[2:] for r in first.collect()), key=repr) == sorted([('x & <y> "z"', "1", "2.5", None, None), (" two\nlines ", None, "-1.0E9", "n", None), ("0012", "7", None, "", None)], key=repr)
    names = {(r["path"].rsplit("/")[-1][5], r["place"]): r["sheet"] for r in read.collect()}
    assert names["A", 2] == "ALL (2)" and len(names["A", 1]) == 31 and not set("/*[]:") & set(names["A", 1])


def test_long_sheets_go_on_and_empty_tables_make_a_book(spark, tmp_path):
    import io

    out = io.BytesIO()
    made = workbook._Book(out, sheet_rows=3)
    for k in range(8):
        made.add(0, "long", [{"text": str(k), "number": True}])
    made.close()
    found = list(workbook.sheet_rows(out.getvalue()))
    assert [(n, t) for _, n, _, (t,) in found] == [(["long", "long (2)", "long (3)"][k // 3], str(k)) for k in range(8)]
    out = io.BytesIO()
    workbook._Book(out).close()
    assert list(workbook.sheet_rows(out.getvalue())) == []


def test_books_of_other_writers(tmp_path):
    """Shared strings, cell references with gaps, numbers, and targets from the package's root."""
    import io
    import zipfile

    main, links = workbook._MAIN, workbook._LINKS
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{links}"><sheets><sheet name="S" sheetId="1" r:id="x"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="p"><Relationship Id="x" Target="/xl/worksheets/s.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>plain</t></si><si><r><t>ri</t></r><r><t>ch</t></r></si></sst>')
        z.writestr("xl/worksheets/s.xml", f'<worksheet xmlns="{main}"><sheetData><row r="1"><c r="A1" t="s"><v>1</v></c><c r="C1"><v>7.5</v></c></row><row r="3"><c r="AB3" t="s"><v>0</v></c></row></sheetData></worksheet>')
    first, second = workbook.sheet_rows(out.getvalue())
    assert first == (0, "S", 0, ["rich", None, "7.5"]) and second[3] == [None] * 27 + ["plain"]


def test_sqlite_scan(spark, tmp_path):
    """Ranges of row ids are partitions; columns and a condition go into the queries."""
    import sqlite3

    db = f"{tmp_path}/products.db"
    with sqlite3.connect(db) as c:
        c.execute('CREATE TABLE produtos (id INTEGER PRIMARY KEY, "a name" TEXT, price REAL, raw BLOB, n INT)')
        c.executemany("INSERT INTO produtos VALUES (?, ?, ?, ?, ?)", [(k * 3, None if k % 7 == 0 else f"n{k % 5}'", k / 4, bytes([k % 256]), k % 11) for k in range(500)])
        c.execute("CREATE TABLE empty (x TEXT)")
    rows = readers.sqlite_table(spark, db, "produtos", partitions=2)
    assert rows.rdd.getNumPartitions() == 2
    with sqlite3.connect(db) as c:
        assert sorted(map(tuple, rows.collect())) == sorted(c.execute("SELECT * FROM produtos").fetchall(), key=lambda r: r[0])
        for condition in ("n = 3 AND price > 10", '"a name" IS NULL', "price <= 3 OR n = 4"):
            want = sorted(c.execute(f"SELECT id, n FROM produtos WHERE {condition}").fetchall())
            assert sorted(map(tuple, readers.sqlite_table(spark, db, "produtos", 3, condition, "id long, n long").collect())) == want and want
            assert sorted((r["id"], r["n"]) for r in rows.where(condition.replace('"', "`")).collect()) == want
        assert rows.count() == 500
    assert readers.sqlite_table(spark, db, "empty").count() == 0
    raw = readers.raw_products(spark, "acme", db, "sqlite", table="produtos")
    assert raw.count() == 500 and set(raw.columns) >= {"sku", "supplier"}


def test_stored_tables_rewrite_only_what_a_batch_touches(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.range(10_000).select(F.format_string("k%06d", "id").alias("key"), F.col("id").alias("v"))
    assert tables.create(rows, path, "key", file_rows=500) == 1

    def files(version):
        return {f for r in json.loads((tmp_path / f"t/versions/{version}.json").read_text())["ranges"] for f, _ in r["files"]}

    assert len(files(1)) > 15
    batch = spark.range(5000, 5100).select(F.format_string("k%06d", "id").alias("key"), F.lit(-1).cast("long").alias("v"))  # 1 % of the keys
    assert tables.upsert(spark, path, batch) == 2
    assert len(files(1) - files(2)) <= 2 and len(files(2) - files(1)) <= 2
    assert tables.read(spark, path).where("v = -1").count() == 100 and tables.read(spark, path).count() == 10_000
    assert tables.read(spark, path, 1).where("v = -1").count() == 0
    more = spark.createDataFrame([("zzz", 1), (None, 2), ("", 3)], "key string, v long")
    assert tables.upsert(spark, path, more) == 3 and tables.read(spark, path).count() == 10_003
    assert tables.delete(spark, path, more.select("key").where("key is not null")) == 4 and tables.read(spark, path).count() == 10_001
    assert tables.upsert(spark, path, batch.limit(0)) == 4  # an empty batch makes no version
    with pytest.raises(Exception, match="boom"):
        tables.change(spark, path, batch, lambda rows: rows.withColumn("v", F.raise_error(F.lit("boom")).cast("long")))
    assert tables.versions(spark, path) == [1, 2, 3, 4] and tables.read(spark, path).count() == 10_001
    with pytest.raises(Exception, match="FileAlreadyExists"):  # another writer was first
        tables._commit(spark, path, 4, {})
    assert tables.create(rows.limit(0), f"{tmp_path}/none", "key") == 1 and tables.read(spark, f"{tmp_path}/none").count() == 0
    assert tables.upsert(spark, f"{tmp_path}/none", batch) == 2 and tables.read(spark, f"{tmp_path}/none").count() == 100


def test_sitemap_addresses(spark):
    xml = "<url><loc> https://a.example/1 </loc></url><url><loc>/relative</loc></url><url><loc><![CDATA[http://b.example]]></loc></url><url><loc>ftp://c</loc></url>"
    assert spark.createDataFrame([(xml,)], "x string").select(web.sitemap_addresses(F.col("x"))).first()[0] == ["https://a.example/1", "http://b.example"]


def test_plain_words_take_ligatures_apart(spark):
    import re
    import unicodedata

    letters = [chr(c) for c in (*range(0x20, 0xD800), *range(0xE000, 0x10000))]
    texts = ["ﬁlé de peixe ½ kg", "㎏ ㎖ ǆ ĳ №", *("".join(letters[at : at + 40]) for at in range(0, len(letters), 40))]
    plain = lambda t: re.sub("[̀-ͯ]", "", unicodedata.normalize("NFKD", re.sub("[̀-ͯ]", "", t)))
    folded = lambda t: " ".join(re.sub("[^a-z0-9]", " ", "".join(c.lower() if c < "\x80" else c for c in plain(t))).split())
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(plain_words(F.col("t"))).collect()]
    assert got[:2] == ["file de peixe 1 2 kg", "kg ml dz ij no"]
    assert [" ".join(g.split()) for g in got] == [folded(t) for t in texts]
