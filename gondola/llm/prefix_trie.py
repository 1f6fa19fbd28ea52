"""The prefix trie of conversations: chained digests name prefixes, equal digests are one node.

A conversation's rows are numbered by one range exchange and chained in blocks of BLOCK turns, and
subtree sums climb in blocks of BLOCK depths, so that neither one very long conversation nor one
that is copied very often gathers in a task. Hot nodes (a first turn that a third of all
conversations share) are counted by partial aggregates; joins to a hot parent are plain equi-joins
that adaptive execution splits.

Rows without conv_id belong to no conversation and are left out. Null roles and texts are empty.
Turns of one number (null first) stand in the order of role and text. An empty table has no node.
Columns beside conv_id, turn, role and text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import map_in_arrow, materialise, numbered

#: Turns chained in one row, and depths that a contribution climbs at once.
BLOCK = 64
#: Conversations of neighbouring ids whose list is made at once.
LIST_IDS = 1024
#: Borrowed turns: fewer than this, from the first conversation of each hundred.
BORROWED, HUNDRED = 6, 100
ROOT = hashlib.sha256(b"").digest()


def _sha(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """conv_id, position (from 0), step (32 bytes that stand for role and text), n_chars (of the text), n_turns."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    step = _sha(F.encode(F.concat_ws(":", F.length(role).cast("string"), role, text), "UTF-8"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.left(role, F.lit(64)).alias("_role"), F.left(text, F.lit(64)).alias("_text"), step.alias("step"), F.length(text).cast("long").alias("n_chars")
    )
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("_role").asc(), F.col("_text").asc(), F.col("step").asc()]
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = numbered(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("conv_id", "step", "n_chars"), "_index", "trie-turns")
    starts = placed.groupBy("conv_id").agg(F.min("_index").alias("_start"), F.count(F.lit(1)).alias("n_turns"))
    return placed.join(starts, "conv_id").select("conv_id", (F.col("_index") - F.col("_start")).alias("position"), "step", "n_chars", "n_turns")


def with_borrowed_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as the first one of their hundred does: (conv_id, depth from 1, step, n_chars, last), (conv_id, length).

    The first h turns come from conversation c - c % 100 (all it has, if fewer), then c's own
    after its first h; h is the CRC-32 of c's decimal digits modulo 6.
    """
    turns = materialise(turns, "trie-turns-in-order")
    own = turns.groupBy("conv_id").agg(F.max("n_turns").alias("n_turns"))
    own = own.withColumns({"_h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % BORROWED, "_base": F.col("conv_id") - F.col("conv_id") % HUNDRED})
    sizes = own.select(F.col("conv_id").alias("_base"), F.col("n_turns").alias("_n_base"))
    lent = F.least("_h", F.coalesce("_n_base", F.lit(0)))
    convs = own.join(sizes, "_base", "left").withColumn("_lent", lent).withColumn("length", F.col("_lent") + F.greatest(F.col("n_turns") - F.col("_h"), F.lit(0)))
    convs = materialise(convs.select("conv_id", "_base", "_h", "_lent", "length"), "trie-conversations")
    kept = turns.join(convs, "conv_id").where("position >= _h").select("conv_id", (F.col("_lent") + F.col("position") - F.col("_h") + 1).alias("depth"), "step", "n_chars", "length")
    heads = turns.where(F.col("position") < BORROWED).select(F.col("conv_id").alias("_base"), "position", "step", "n_chars")
    borrowed = heads.join(convs, "_base").where("position < _h").select("conv_id", (F.col("position") + 1).alias("depth"), "step", "n_chars", "length")
    rows = kept.unionByName(borrowed)
    return rows.select("conv_id", "depth", "step", "n_chars", (F.col("depth") == F.col("length")).alias("last")), convs.select("conv_id", "length")


def _deepest(df: DataFrame) -> int:
    return df.agg(F.max("depth")).first()[0] or 0


def chained(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """turns (conv_id, depth 1..n, step, more columns) with digest and before (digest of the prefix one shorter).

    Each block of turns is chained from the root by itself; the digests of whole blocks are the
    turns of a shorter conversation that is chained in the same way, and seed the blocks after them.
    """
    carried = [c for c in turns.columns if c != "conv_id"]
    root = F.lit(ROOT)
    blocks = turns.groupBy("conv_id", F.floor((F.col("depth") - 1) / block).alias("_block")).agg(F.sort_array(F.collect_list(F.struct(*carried))).alias("_turns"))
    chain = F.aggregate("_turns", F.array(root), lambda seen, t: F.concat(seen, F.array(_sha(F.element_at(seen, -1), t["step"]))))
    rows = F.transform("_turns", lambda t, i: F.struct(*[t[c].alias(c) for c in carried], F.get("_chain", i + 1).alias("_own"), F.when(i > 0, F.get("_chain", i)).alias("_before")))
    rows = blocks.withColumn("_chain", chain).select("conv_id", "_block", F.inline(rows))
    deep = materialise(rows, "trie-chains")

    def seeded(df: DataFrame, seed: Column, tail: Column) -> DataFrame:
        before = F.when(F.col("_before").isNull(), tail).otherwise(_sha(seed, F.col("_before")))
        return df.select("conv_id", *carried, _sha(seed, F.col("_own")).alias("digest"), before.alias("before"))

    first = seeded(deep.where("_block = 0"), root, root)
    if _deepest(deep) <= block:
        return first
    whole = deep.where(F.col("depth") % block == 0).select("conv_id", (F.col("depth") / block).cast("long").alias("depth"), F.col("_own").alias("step"))
    seeds = chained(whole, block).select("conv_id", F.col("depth").alias("_block"), F.col("digest").alias("_seed"), _sha(F.col("before"), F.col("step")).alias("_tail"))
    return first.unionByName(seeded(deep.where("_block > 0").join(seeds, ["conv_id", "_block"]), F.col("_seed"), F.col("_tail")))


def subtree_sums(shares: DataFrame, paths: DataFrame, columns: list[str], block: int = BLOCK) -> DataFrame:
    """digest, depth, conv_id (of one path through it) and the sums of columns over the node's subtree.

    shares holds what single nodes add (conv_id of a path that ends there or goes on, depth,
    columns), paths every prefix (conv_id, depth, digest). A share is exploded to all ancestors of
    its block of depths; the blocks' top nodes are a shallower trie, summed in the same way, whose
    sums go once more to all ancestors of the block above. With at most BLOCK depths that is one
    explosion to all ancestors.
    """
    at = lambda c: F.floor(F.col(c) / block)
    up = paths.withColumn("_block", at("depth"))

    def climb(found: DataFrame) -> DataFrame:
        found = found.select("conv_id", "_block", F.col("depth").alias("_from"), *columns)
        return found.join(up, ["conv_id", "_block"]).where("depth <= _from").select("digest", "depth", "conv_id", *columns)

    def summed(df: DataFrame) -> DataFrame:
        return df.groupBy("digest", "depth").agg(F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in columns])

    inside = summed(climb(shares.withColumn("_block", at("depth"))))
    if _deepest(paths) < block:
        return inside
    inside = materialise(inside, "trie-sums")
    shallower = lambda df: df.where(F.col("depth") % block == 0).withColumn("depth", (F.col("depth") / block).cast("long"))
    tops = materialise(subtree_sums(shallower(inside).select("conv_id", "depth", *columns), shallower(paths), columns, block), "trie-tops")
    below = tops.where("depth > 0").withColumns({"_block": F.col("depth") - 1, "depth": F.col("depth") * block - 1})
    return summed(inside.unionByName(climb(below)))


def _hashed_lists(batches):
    """digest, ends_sha256: the SHA-256 of each digest's lists of ids; its pieces come in order."""
    digest, sha, found = None, None, ([], [])
    for b in batches:
        for key, ids in zip(b.column("digest").to_pylist(), b.column("ids").to_pylist(), strict=True):
            if key != digest:
                if sha is not None:
                    found[0].append(digest)
                    found[1].append(sha.hexdigest())
                digest, sha = key, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
        yield pa.record_batch([pa.array(found[0], pa.binary()), pa.array(found[1], pa.string())], names=["digest", "ends_sha256"])
        found = ([], [])
    if sha is not None:
        yield pa.record_batch([pa.array([digest], pa.binary()), pa.array([sha.hexdigest()], pa.string())], names=["digest", "ends_sha256"])


def hashed_members(ends: DataFrame) -> DataFrame:
    """digest, ends_sha256: SHA-256 of the decimal conv_ids of ends (digest, conv_id), ascending, joined by commas.

    Lists are made for ids of one range of LIST_IDS; a hash takes them one after the other.
    """
    pieces = ends.groupBy("digest", F.floor(F.col("conv_id") / LIST_IDS).alias("piece")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    pieces = pieces.select("digest", "piece", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    ordered = pieces.repartition("digest").sortWithinPartitions("digest", "piece").select("digest", "ids")
    return map_in_arrow(ordered, _hashed_lists, "digest binary, ends_sha256 string")


def trie(turns: DataFrame, conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """The nodes of conversations given as turns (conv_id, depth 1..n, step, n_chars, last) and (conv_id, length).

    Per node: digest, depth, conv_id (smallest member), parent_conv_id, n_convs, n_children,
    n_leaves and saved_tokens (over its subtree), ends_sha256.
    """
    root = conversations.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("digest"), F.lit(None).cast("binary").alias("before"), F.lit(0).cast("long").alias("n_chars"), (F.col("length") == 0).alias("last"))
    prefixes = materialise(chained(turns, block).select(root.columns).unionByName(root), "trie-prefixes")
    nodes = prefixes.groupBy("depth", "digest", "before", "n_chars").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    nodes = materialise(nodes, "trie-nodes")
    children = nodes.where("before IS NOT NULL").groupBy(F.col("before").alias("digest")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialise(nodes.join(children, "digest", "left").fillna(0, ["n_children"]), "trie-parents")
    shares = nodes.select("conv_id", "depth", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved_tokens"))
    sums = subtree_sums(shares.where("n_leaves > 0 OR saved_tokens > 0"), prefixes.select("conv_id", "depth", "digest"), ["n_leaves", "saved_tokens"], block)
    ends = hashed_members(prefixes.where("last").select("digest", "conv_id"))
    parents = nodes.select(F.col("digest").alias("before"), F.col("conv_id").alias("parent_conv_id"))
    whole = nodes.join(sums.drop("depth", "conv_id"), "digest").join(ends, "digest", "left").join(parents, "before", "left")
    return whole.select("digest", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def shared_prefixes(conversations: DataFrame) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text), each begun by turns borrowed from the first of its hundred."""
    return trie(*with_borrowed_turns(turns_in_order(conversations)))
