"""The registered queries of the corpus operators, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.llm import alignment, embedding_join, fingerprint, html_extract, mixing, oracles, packing, prefix_trie, quality, secret_scan, sharding, simhash, training_order, warc
from gondola.llm.common import materialise, shared_path


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    plan = mixing.mixing_plan(docs)
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.sharded(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_style_tree_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return html_extract.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    spans = F.coalesce("spans", F.array().cast("array<struct<start:int,end:int,kind:string,base:boolean,verdict:string,owners:bigint,repositories:bigint>>"))
    count = lambda kind: F.size(F.filter("_spans", lambda x: x["kind"] == kind)).cast("long")
    digest = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    each = lambda field: F.array_join(F.transform("_spans", lambda x: x[field].cast("string")), ",")
    return secret_scan.scan(docs).withColumn("_spans", spans).select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(digest(F.filter("_spans", lambda x: x["base"])), 256).alias("base_sha256"),
        digest(F.col("_spans")).alias("spans"),
        each("verdict").alias("verdicts"),
        each("owners").alias("owners"),
        each("repositories").alias("repositories"),
    )


def op5_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "training-shards")
    stream = training_order.token_sequences(spark.read.parquet(f"{sf_dir}/documents.parquet"), stored=True)
    training_order.write_shards(training_order.in_training_order(stream), path)
    placed = training_order.in_training_order(stream, with_ids=False)
    placed = placed.select("slot", "shard", "record", training_order.byte_offset(F.col("record")).alias("byte_offset"), "doc_ids", "starts", "lengths")
    return placed.join(training_order.read_shards(spark, path), "slot")


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_groups(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


def op7_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    prints = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return simhash.near_groups(docs).select("doc_id", prints.alias("fingerprint"), "component_id")


def op9_warc_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), path)
    captures = warc.assemble(materialise(warc.read_records(spark, path), "warc-records"))
    return captures.select(
        "page_id",
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.record_type").alias("record_type"),
        F.col("refers_to_page").alias("refers_to"),
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return quality.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = prefix_trie.shared_prefixes(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprint.edited(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    own, new, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited_text", 256).alias("edited_sha256"),
        fingerprint.printed(own).alias("fingerprint"),
        fingerprint.printed(new).alias("edited_fingerprint"),
        fingerprint.resemblance(own, new).alias("near_edited"),
        fingerprint.resemblance(own, following).alias("near_next"),
        fingerprint.containment(own, new).alias("held_by_edited"),
        fingerprint.distinct_shingles(own).alias("distinct_shingles"),
    )


def queries():
    return {
        "op1_source_mixing": op1_source_mixing,
        "op2_sharding": op2_sharding,
        "op3_style_tree_extraction": op3_style_tree_extraction,
        "op4_secret_scan": op4_secret_scan,
        "op5_training_order": op5_training_order,
        "op6_embedding_dedup": op6_embedding_dedup,
        "op7_lexical_packing": op7_lexical_packing,
        "op8_simhash_dedup": op8_simhash_dedup,
        "op9_warc_assembly": op9_warc_assembly,
        "op10_quality_rules": op10_quality_rules,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_token_alignment": op12_token_alignment,
        "op13_document_fingerprints": op13_document_fingerprints,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_source_mixing": oracles.MIXING,
        "op2_sharding": oracles.SHARDS,
        "op4_secret_scan": oracles.SECRETS,
        "op6_embedding_dedup": oracles.EMBEDDINGS,
        "op9_warc_assembly": oracles.ARCHIVES,
        "op10_quality_rules": oracles.QUALITY,
        "op11_prefix_trie": oracles.TRIE,
    }
