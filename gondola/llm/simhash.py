"""SimHash near-dedup by pigeonhole blocks.

Fingerprints are computed in Arrow batches; equal ones are one from then on. A fingerprint is cut
into five blocks; two that differ in at most two bits agree in three blocks at least, so each is
sent out under every three of its blocks, joined inside those buckets, and the Hamming distance
verified. Buckets over BUCKET_MAX members are not joined pair by pair: each of their members is
sent out under itself and its 64 one-bit neighbours instead, and members that meet there differ
in at most two bits (a bucket then holds 65 at most), so no link is lost. Links become components.

Defined cases: a null text counts as empty; texts without words have fingerprint zero, which links
like any other; repeated rows share a fingerprint and stay one row each; null ids don't
become a component's id unless all of its ids are null; an empty table gives no rows. Dropping
copies keeps one row a group, by keys of whole rows: rows that share a null or repeated doc_id but
no text are groups of their own and all stay.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from gondola.llm.common import connected_components, map_in_arrow, materialise

BLOCKS = (13, 13, 13, 13, 12)
DISTANCE = 2
BUCKET_MAX = 12
_CHUNK = 1 << 15


def fingerprint(raw: bytes, words: int = 3, seed: int = 42) -> int:
    """SimHash of the shingles' XXH64, as a signed 64-bit integer; raw is UTF-8."""
    found = raw.lower().split()  # bytes: A-Z and the six ASCII white-space characters alone
    if not found:
        return 0
    shingles = map(b" ".join, zip(*[found[k:] for k in range(words)])) if len(found) >= words else [b" ".join(found)]
    return majority(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.dtype("<u8"), max(1, len(found) - words + 1)))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes, as a signed 64-bit integer."""
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        bits = np.unpackbits(hashes[at : at + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp (signed 64-bit) of every row of docs(doc_id, text); also: columns of longs that go along."""

    def run(batches):
        for b in batches:
            prints = [fingerprint(t or b"", words) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), *b.columns[2:], pa.array(prints, pa.int64())], ["doc_id", *also, "fp"])

    return map_in_arrow(narrow(docs, also), run, f"doc_id long, {''.join(f'{c} long, ' for c in also)}fp long")


def narrow(docs: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), *also)


def block_keys(fp: Column) -> Column:
    """Array of (which, key): the fingerprint under every three of its blocks."""
    blocks, at = [], 0
    for width in BLOCKS:
        blocks.append(F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1)) if at else fp.bitwiseAND(F.lit((1 << width) - 1)))
        at += width
    keys = []
    for which, chosen in enumerate(combinations(range(len(BLOCKS)), len(BLOCKS) - DISTANCE)):
        key = F.lit(0).cast("long")
        for b in chosen:
            key = F.shiftleft(key, BLOCKS[b]).bitwiseOR(blocks[b])
        keys.append(F.struct(F.lit(which).alias("which"), key.alias("key")))
    return F.array(*keys)


def near_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints of prints(fp) within two bits: all of them, or as many as connect the same ones."""
    keyed = prints.select("fp", F.inline(block_keys(F.col("fp"))))
    sizes = keyed.groupBy("which", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = materialise(keyed.join(sizes, ["which", "key"]), "simhash-buckets")
    bucket = met.where(F.col("n") <= BUCKET_MAX).groupBy("which", "key").agg(F.collect_list("fp").alias("fps"))
    pairs = bucket.select(F.explode("fps").alias("a"), "fps").select("a", F.explode("fps").alias("b"))
    pairs = pairs.where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE))
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << k if k < 63 else -(1 << 63)).cast("long") for k in range(64)])
    dense = met.where(F.col("n") > BUCKET_MAX).select("fp").distinct()
    near = dense.select("fp", F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("mid"))
    # at most 65 distinct fingerprints lie within one bit of mid
    star = near.groupBy("mid").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    star = star.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")
    return pairs.union(star)


def distinct_prints(own: DataFrame, label: str) -> DataFrame:
    """fp, first (its smallest doc_id) of own(doc_id, fp)."""
    return materialise(own.groupBy("fp").agg(F.min("doc_id").alias("first")), f"{label}-distinct")


def groups_of(own: DataFrame, prints: DataFrame, links: DataFrame, label: str) -> DataFrame:
    """own(doc_id, fp, ...) with class (one for each group) and component_id (its smallest doc_id), by links(a, b) of fps."""
    nodes = connected_components(links, label)
    named = prints.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").withColumn("class", F.coalesce("component", "fp"))
    classes = named.groupBy("class").agg(F.min("first").alias("component_id"))
    return own.join(named.join(classes, "class").select("fp", "class", "component_id"), "fp")


def near_groups(docs: DataFrame, words: int = 3, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp, class, component_id (the smallest doc_id reachable by links) of every row; also: columns of longs that go along."""
    own = materialise(fingerprints(docs, words, also), "simhash-prints")
    prints = distinct_prints(own, "simhash")
    return groups_of(own, prints, near_links(prints.select("fp")), "simhash")


#: The names of a row's key.
ROW_KEY = ("_row_a", "_row_b")
#: A table of row keys up to this many (about 60 bytes each) is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 500_000


def with_row_key(docs: DataFrame) -> DataFrame:
    """doc_id, text, _doc (the whole row) and two 64-bit hashes of it (columns of maps aside): rows that share them are repeated rows."""
    cols = [F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, MapType)]
    parts = [p for c in cols for p in (c, c.isNull())]  # a null alone leaves the hash as it is
    hashes = [F.xxhash64(F.lit(seed), *parts).alias(name) for seed, name in enumerate(ROW_KEY)]
    return docs.select("doc_id", "text", F.struct(*docs.columns).alias("_doc"), *hashes)


def keep_first(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """One row of each class of groups(class, doc_id, *ROW_KEY): that with the smallest doc_id (null last), then the smallest key; columns as they came.

    Decided on the keys alone. Only rows that go, and rows that stay but are repeated, are looked
    up: by a broadcast if they are few, else by a shuffle join. docs: of with_row_key.
    """
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), *ROW_KEY)
    rows = groups.groupBy("class", *ROW_KEY).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"))
    rows = materialise(rows, "copies-rows")
    first = rows.groupBy("class").agg(F.min(order).alias("_first"), F.sum("n").alias("_all")).where("_all > 1").select("class", "_first")
    first = materialise(first, "copies-first")
    if first.count() <= BROADCAST_ROWS:
        first = F.broadcast(first)
    stays = (F.col("_first")[ROW_KEY[0]] == F.col(ROW_KEY[0])) & (F.col("_first")[ROW_KEY[1]] == F.col(ROW_KEY[1]))
    told = rows.join(first, "class").withColumn("_stays", stays).where("not _stays or n > 1")
    told = materialise(told.select(*ROW_KEY, "_stays"), "copies-told")
    found = {r["_stays"]: r["n"] for r in told.groupBy("_stays").agg(F.count(F.lit(1)).alias("n")).collect()}
    if sum(found.values()) <= BROADCAST_ROWS:
        told = F.broadcast(told)
    held = docs.join(told, list(ROW_KEY), "left")
    kept = held.where("_stays is null").select("_doc.*")
    if True in found:
        kept = kept.union(held.where("_stays").dropDuplicates(list(ROW_KEY)).select("_doc.*"))
    return kept


def drop_near_copies(docs: DataFrame, words: int = 3) -> DataFrame:
    """One row of each group, as keep_first; columns as they came."""
    keyed = with_row_key(docs)
    return keep_first(keyed, near_groups(keyed, words, ROW_KEY))
