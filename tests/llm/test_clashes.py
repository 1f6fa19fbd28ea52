"""Extra columns named like those that operators use for their own change nothing."""

import pytest
from pyspark.sql import functions as F

from gondola.llm import embedding_join, html_extract, near_copies, packing, quality, secret_scan, simhash, training_order, warc
from tests.llm.test_documents import CLASHES, ROWS, SCHEMA

MORE = "dim v cell far side root component n n_links kept c1 b1 start length offset sequence_id doc_tokens ids_crc32 file split record html_ plain _plain _repeated pages_ text_ class star0 sh pos label".split()


def clashing(df):
    have = {c.lower() for c in df.columns}
    return df.withColumns({c: F.lit("clash") for c in (*CLASHES, *MORE) if c.lower() not in have})


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


@pytest.mark.parametrize(
    "run",
    [packing.pack, simhash.near_groups, near_copies.near_groups, lambda d: secret_scan.scan(d).drop("_row"), lambda d: training_order.in_training_order(training_order.token_sequences(d, tokens=64)).drop("ids")],
    ids=["packing", "simhash", "near_copies", "secret_scan", "training_order"],
)
def test_documents(spark, run):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    same(run(docs.repartition(1)), run(clashing(docs).repartition(1)))


def test_verdicts_stay_beside_clashing_columns(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    ours = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    same(quality.judge(docs).select(*ours), quality.judge(clashing(docs)).select(*ours))


def test_pages(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    same(html_extract.extract(pages), html_extract.extract(clashing(pages)))
    for name, df in (("plain", pages), ("clash", clashing(pages))):
        warc.write_archives(df, f"{tmp_path}/{name}")
    plain, clash = (warc.assemble(warc.read_records(spark, f"{tmp_path}/{name}")).select("page_id", "refers_to_page", "response.payload_digest") for name in ("plain", "clash"))
    same(plain, clash)


def test_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    same(embedding_join.near_groups(vectors), embedding_join.near_groups(clashing(vectors)))
