"""Document fingerprints: the K smallest hashes of a text's distinct word shingles (a bottom-k sketch).

Shingles are of WORDS words as they stand (runs of anything but the six ASCII white-space
characters, joined by one space); a text of fewer words is one shingle, one without words none. A
shingle's hash is its XXH64 (UTF-8, seed 42), in the order of signed integers. Sketches of parts
merge into the sketch of the whole, so groups of any size are sketched in rounds of bounded
groups. A sketch of fewer than K hashes is the whole set, and what is told of it exact.

All expressions are Spark's own functions. A text's words are held at once, as an array.

Defined cases: a null text is empty; sketches without hashes are alike (1.0) and hold one another;
repeated rows stay, each followed by its like and the last of them by the next document; null ids
come first in the order and stay null; a lone document is its own next one; an empty table gives
no rows. Only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import materialise, text_or_empty, with_global_index

WORDS, K = 5, 128
#: Sketches merged at once (about).
FAN_IN = 256
#: The part of a text that is exchanged for the start of the next one: one in so many code points.
EDITED = 4
_SPACE = r"[\x20\x09-\x0D]+"


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """The hash of every shingle of a text, in order."""
    found = F.array_remove(F.split(text, _SPACE), "")
    each = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - (words - 1)), lambda i: F.xxhash64(F.array_join(F.slice(w, i, words), " ")))
    few = lambda w: F.when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(F.array().cast("array<bigint>"))
    # the words once, as the only element of an array
    return F.flatten(F.transform(F.array(found), lambda w: F.when(F.size(w) >= words, each(w)).otherwise(few(w))))


def smallest(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, words: int = WORDS, k: int = K) -> Column:
    """The sketch of a text, as an ascending array."""
    return smallest(shingle_hashes(text, words), k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of all that a and b were made of."""
    return smallest(F.concat(a, b), k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the share of the union's k smallest hashes that both have."""
    union = merged(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b)) / F.size(union)
    return F.when(F.size(union) == 0, 1.0).otherwise(both)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else from how small the k-th hash is."""
    part = (F.element_at(a, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / part)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has."""
    union = merged(a, b, k)
    shared = resemblance(a, b, k) * distinct_shingles(union, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def printed(a: Column) -> Column:
    """The sketch as a string of 16 hexadecimal digits a hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def merged_by(sketches: DataFrame, keys: list[str], name: str = "sketch", k: int = K, fan_in: int = FAN_IN) -> DataFrame:
    """keys and the merged sketch of each group's rows, whatever its size: equal sketches are one, then about fan_in are merged at a time."""
    held = materialise(sketches.groupBy(*keys, name).agg(F.count(F.lit(1)).alias("_n")).drop("_n"), "sketches")
    while True:
        sizes = held.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / fan_in).cast("long").alias("_buckets"))
        sizes = materialise(sizes, "sketch-groups")
        same = [held[c].eqNullSafe(sizes[c]) for c in keys]
        dealt = held.join(sizes, same, "inner").select(*[held[c] for c in keys], held[name], F.pmod(F.xxhash64(held[name]), sizes["_buckets"]).alias("_bucket"))
        held = materialise(dealt.groupBy(*keys, "_bucket").agg(smallest(F.flatten(F.collect_list(name)), k).alias(name)).drop("_bucket"), "sketches")
        if (sizes.agg(F.max("_buckets")).first()[0] or 1) == 1:
            return held


def _with_key(docs: DataFrame) -> DataFrame:
    """doc_id, text and a key that rows share if both are equal."""
    text, doc_id = text_or_empty(), F.col("doc_id").cast("long")
    key = F.unhex(F.sha2(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), text), 256))
    return docs.select(doc_id.alias("doc_id"), text.alias("text"), key.alias("key"))


def _followers(keyed: DataFrame) -> DataFrame:
    """key, of, need, copies: the text of key follows that of of, whose edit takes need code points of it, in so many rows."""
    rows = keyed.groupBy("doc_id", "key", F.length("text").cast("long").alias("n_chars")).agg(F.count(F.lit(1)).alias("n"))
    placed = with_global_index(rows, [F.col("doc_id").asc_nulls_first(), F.col("key").asc()], "at", "fingerprint-order")
    total = placed.count()
    after = placed.select("key", F.pmod(F.col("at") - 1, F.lit(max(total, 1))).alias("at"))
    before = placed.select(F.col("key").alias("of"), "at", F.floor(F.col("n_chars") / EDITED).cast("int").alias("need"), "n")
    following = before.join(after, "at").select("key", "of", "need", F.lit(1).cast("long").alias("copies"))
    own = before.where("n > 1").select(F.col("of").alias("key"), "of", "need", (F.col("n") - 1).alias("copies"))
    return materialise(following.unionByName(own), "fingerprint-followers")


def edited(docs: DataFrame, words: int = WORDS, k: int = K) -> DataFrame:
    """Every row of docs(doc_id, text): doc_id, text, edited_text, sketch, edited_sketch, next_sketch.

    The last quarter of a text's code points (rounded down) is exchanged for the first as many of
    the next document in ascending order of doc_id (of all rows of one doc_id, by their keys; after the last the first). Whole
    texts are exchanged once, by key; what goes to the text before is that quarter and a sketch.
    """
    keyed = _with_key(docs)
    # the row as one column: both uses read the same, so the exchange is made once
    texts = keyed.groupBy("key").agg(F.first(F.struct("doc_id", "text")).alias("row")).select("key", "row.doc_id", "row.text")
    heads = texts.join(_followers(keyed), "key").select(F.col("of").alias("key"), "need", "copies", F.left("text", F.col("need")).alias("head"), sketch(F.col("text"), words, k).alias("next_sketch"))
    both = texts.join(heads, "key").withColumn("edited_text", F.concat(F.left("text", F.length("text") - F.col("need")), F.col("head")))
    made = both.select("doc_id", "text", "edited_text", sketch(F.col("text"), words, k).alias("sketch"), sketch(F.col("edited_text"), words, k).alias("edited_sketch"), "next_sketch", "copies")
    return made.withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies")
