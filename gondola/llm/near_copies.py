"""Near copies by exact Jaccard similarity of word shingles, with candidates from SimHash blocks and a prefix join.

A text is the set of its five-word shingles (XXH64 each; words as in simhash); texts with equal sets
are one from then on. Sets get SimHash fingerprints; those that simhash's pigeonhole blocks bring
together are compared as a whole. Sets of a similarity near 4/5 differ in more bits than blocks can
bridge, so an exact way follows for these. Two sets with a similarity of 4/5 or more share a shingle among the first
n // 5 + 1 of each, whatever order all sets are sorted by, so those prefixes are exchanged by
shingle, and sets that meet there and aren't known to be of one group are compared as a whole: no
group is torn, none below is linked. The order puts shingles that are common in a sample of the
texts last, so few sets meet in vain; the sample decides the amount of work only. A shingle that very
many unlike sets hold even so is cut into parts of TILE members, and every two parts are a group of
their own, so no task holds more than two. Links become components.

Defined cases: a null text counts as empty; texts without words have one empty set and are copies of
each other; a text shorter than a shingle is one shingle; repeated rows share a set; an empty table
gives no rows.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import connected_components, map_in_arrow, materialise, slices
from gondola.llm.simhash import BROADCAST_ROWS, ROW_KEY, groups_of, keep_first, majority, narrow, with_row_key
from gondola.llm.simhash import near_links as near_prints
from gondola.llm.tokenizing import release

WORDS = 5
#: One set in so many is looked at for common shingles, and so many of these (at least COMMON_LEAST there) are put last.
SAMPLE, COMMON, COMMON_LEAST = 16, 100_000, 3
_PAIRS = 1 << 16
#: Seeds of the draws of stars.
_DRAWS = (0x51ED270B, 0x2545F491, 0x6C62272E)
_STARS = [f"star{k}" for k in range(len(_DRAWS))]
_PARITIES = [f"parities{k}" for k in range(4)]
#: Partners that a set is compared with in one task.
CELL = 256
#: Members of a shingle (about 80 bytes each) that are held at once.
TILE = 8192


def shingles(raw: bytes) -> np.ndarray:
    """The distinct shingles' XXH64, ascending; raw is UTF-8."""
    found = raw.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    parts = map(b" ".join, zip(*[found[k:] for k in range(WORDS)])) if len(found) >= WORDS else [b" ".join(found)]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(42)), np.uint64))


def key_of(hashes: np.ndarray) -> int:
    """A set's key, as a signed 64-bit integer."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.astype("<u8").tobytes())).view(np.int64))


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the similarity of two sets is at least 4/5."""
    return 9 * len(np.intersect1d(a, b, assume_unique=True)) >= 4 * (len(a) + len(b))


def parities(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits (a power of two, at least 1,024 and as many as hashes) and 256 bits, as signed 64-bit integers: of each value of the hashes' last bits, whether an odd number has it.

    Two sets' parities differ in at most as many bits as the sets have shingles that the other lacks.
    The halves' XOR is that of half as many bits.
    """
    size = max(1024, 1 << max(len(hashes) - 1, 0).bit_length())
    odd = np.bincount((hashes & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return tuple(np.packbits(x.astype(np.uint8)).view(np.int64) for x in (odd, odd.reshape(-1, 256).sum(axis=0) & 1))


def set_keys(docs: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp (the key of its set), n (shingles), print (its SimHash), its parities and more of them (wide) of every row of docs(doc_id, text); also: columns of longs that go along."""

    def run(batches):
        release()  # a stage before may have filled this worker's cache
        for b in slices(batches):
            sets = [shingles(t or b"") for t in b.column(1).to_pylist()]
            keys, bits = [key_of(h) for h in sets], [parities(h) for h in sets]
            short = np.array([x[1] for x in bits], np.int64).reshape(-1, len(_PARITIES))
            columns = [pa.array(keys, pa.int64()), pa.array([len(h) for h in sets], pa.int64()), pa.array([majority(h) for h in sets], pa.int64()), *map(pa.array, short.T.copy()), pa.array([x[0] for x in bits], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), *b.columns[2:], *columns], ["doc_id", *also, "fp", "n", "print", *_PARITIES, "wide"])

    return map_in_arrow(narrow(docs, also), run, f"doc_id long, {', '.join(f'{c} long' for c in (*also, 'fp', 'n', 'print', *_PARITIES))}, wide array<bigint>")


def distinct_sets(own: DataFrame) -> DataFrame:
    """fp, first (its smallest doc_id), n, print, parities, wide of set_keys."""
    return materialise(own.groupBy("fp").agg(F.min("doc_id").alias("first"), *[F.max(c).alias(c) for c in ("n", "print", *_PARITIES)], F.first("wide").alias("wide")), "copies-distinct")


def common_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that are common in a sample of the distinct sets, ascending, and how many sets there hold each."""

    def run(batches):
        seen = set()
        for b in batches:
            for t in b.column(1).to_pylist():
                h = shingles(t or b"")
                if (fp := key_of(h)) % SAMPLE == 0 and fp not in seen:
                    seen.add(fp)
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["sh"])

    counts = map_in_arrow(narrow(docs), run, "sh long").groupBy("sh").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= COMMON_LEAST)
    top = counts.orderBy(F.desc("n"), "sh").limit(COMMON).collect()
    hashes = np.array([r["sh"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.array([r["n"] for r in top], np.int64)[order]


def prefixes(docs: DataFrame, common: np.ndarray, counts: np.ndarray) -> DataFrame:
    """sh, fp, n, pos: of every set of n shingles the first n // 5 + 1, with their places."""

    def run(batches):
        seen = set()
        for b in batches:
            for t in b.column(1).to_pylist():
                h = shingles(t or b"")
                fp = key_of(h)
                if fp in seen or not len(h):
                    continue
                seen.add(fp)
                weight = np.zeros(len(h), np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, h), len(common) - 1)
                    weight = np.where(common[at] == h, counts[at], 0)
                first = h[np.lexsort((h, weight))[: len(h) // 5 + 1]]
                k = len(first)
                columns = [first.view(np.int64), np.full(k, fp), np.full(k, len(h), np.int32), np.arange(k, dtype=np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["sh", "fp", "n", "pos"])

    return map_in_arrow(narrow(docs), run, "sh long, fp long, n int, pos int")


def _groups(batches, columns: int, keys: int = 1, most: int | None = None):
    """Part, whether it is the only one, and rows (as an array, a row for each column) of every key of two rows or more.

    Batches are sorted by the first columns, the keys. A key of over most rows comes in parts of so many.
    """

    def parts(block, part):
        """The rows of one key from that part on; the last part is what is left."""
        alone = part == 0 and (most is None or block.shape[1] <= most)
        while most is not None and block.shape[1] > most:
            yield part, False, block[:, :most]
            part, block = part + 1, block[:, most:]
        if not alone or block.shape[1] > 1:
            yield part, alone, block

    held, part = np.zeros((columns, 0), np.int64), 0
    for b in batches:
        block = np.concatenate([held, np.stack([b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(columns)])], axis=1)
        edges = (np.flatnonzero((np.diff(block[:keys], axis=1) != 0).any(axis=0)) + 1).tolist()
        for begin, end in zip([0, *edges], edges):
            yield from parts(block[:, begin:end], part)
            part = 0
        held = block[:, edges[-1] :] if edges else block  # the last key may go on in the next batch
        while most is not None and held.shape[1] > most:
            yield part, False, held[:, :most]
            part, held = part + 1, held[:, most:]
    if held.shape[1]:
        yield from parts(held, part)


def _may_be_alike(n: np.ndarray, left: np.ndarray, m: int, rest: int) -> np.ndarray:
    """Whether sets of n shingles, left from the one they share on, can be alike to one of m with rest left."""
    return 9 * np.minimum(left, rest) >= 4 * (n + m)


def _blocks(found, names: list[str]):
    """Arrays (a row for each column) as record batches of about _PAIRS rows."""
    out, size = [], 0
    for block in found:
        out.append(block)
        size += block.shape[1]
        if size >= _PAIRS:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(out, axis=1)], names)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(out, axis=1)], names)


def buckets(rows: DataFrame) -> DataFrame:
    """sh, fp, n, pos, part, star0, star1, ...: the members of every shingle that two or more distinct sets hold in their prefixes.

    A shingle of over TILE members comes in parts. A star is a member drawn from those of a part and
    of about one size (up to 5/4 of the smallest), the same for all of them; itself for a member
    that can't be alike to it.
    """

    def run(batches):
        def starred():
            for part, alone, (sh, fp, n, pos) in _groups(batches, 4, most=TILE):
                _, first = np.unique(fp, return_index=True)
                if alone and len(first) < 2:
                    continue
                first = first[np.lexsort((fp[first], n[first]))]
                fp, n, pos = fp[first], n[first], pos[first]
                drawn = [(fp.view(np.uint64) ^ np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15) for seed in _DRAWS]
                stars = np.empty((len(_DRAWS), len(fp)), np.int64)
                at = 0
                while at < len(fp):
                    end = int(np.searchsorted(n, 5 * n[at] // 4, side="right"))
                    for star, draw in zip(stars, drawn):
                        k = at + int(draw[at:end].argmin())
                        fits = _may_be_alike(n[at:end], n[at:end] - pos[at:end], n[k], n[k] - pos[k])
                        star[at:end] = np.where(fits, fp[k], fp[at:end])
                    at = end
                yield np.stack([sh[: len(fp)], fp, n, pos, np.full(len(fp), part), *stars])

        return _blocks(starred(), ["sh", "fp", "n", "pos", "part", *_STARS])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "sh").sortWithinPartitions("sh", "fp")
    return map_in_arrow(dealt, run, f"sh long, fp long, n long, pos long, part long, {', '.join(f'{c} long' for c in _STARS)}")


def crossing(rows: DataFrame) -> DataFrame:
    """Distinct pairs (a, b), a < b, of members of a bucket that have different labels and may be alike; rows(sh, fp, n, pos, part, label, parities).

    Each part of a shingle meets each part of it, itself included, in a group of its own.
    """
    # a shingle has parts only if it has over TILE members, so these are few: one row for so many at least
    split = F.broadcast(materialise(rows.where("part > 0").groupBy("sh").agg(F.max("part").alias("_last")), "copies-split"))
    met = lambda q: F.struct(F.least("part", q).alias("one"), F.greatest("part", q).alias("other"))
    tiles = F.transform(F.sequence(F.lit(0).cast("long"), F.coalesce("_last", F.lit(0).cast("long"))), met)
    tiled = rows.join(split, "sh", "left").select("sh", F.inline(tiles), "fp", "n", "pos", "part", "label", *_PARITIES)

    def run(batches):
        def pairs():
            for _, _, block in _groups(batches, 8 + len(_PARITIES), keys=3):
                across = block[1, 0] != block[2, 0]
                fp, n, pos, part, label = block[3:8]
                names, of = np.unique(label, return_inverse=True)
                if len(names) < 2:
                    continue
                # members of the most frequent label last: they need no look at one another
                order = np.argsort(of == np.bincount(of).argmax(), kind="stable")
                fp, of, n, left, part, bits = fp[order], of[order], n[order], (n - pos)[order], part[order], block[8:, order].view(np.uint64)
                for k in range(len(fp) - int(np.bincount(of).max())):
                    rest = slice(k + 1, None)
                    may = (of[rest] != of[k]) & _may_be_alike(n[rest], left[rest], n[k], left[k])
                    at = np.flatnonzero(may & (part[rest] != part[k]) if across else may) + k + 1
                    near = at[9 * np.bitwise_count(bits[:, at] ^ bits[:, k : k + 1]).sum(axis=0, dtype=np.int64) <= n[at] + n[k]]
                    if len(near):
                        yield np.stack([np.minimum(fp[near], fp[k]), np.maximum(fp[near], fp[k])])

        return _blocks(pairs(), ["a", "b"])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tiled.repartition(parts, "sh", "one", "other").sortWithinPartitions("sh", "one", "other")
    return map_in_arrow(dealt, run, "a long, b long").distinct()


def _few(df: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if its size allows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def possible(pairs: DataFrame, prints: DataFrame) -> DataFrame:
    """Those of pairs(a, b) whose sets' wide parities don't rule out that they are alike, so only these sets are moved."""
    for side in ("a", "b"):
        pairs = pairs.join(prints.select(F.col("fp").alias(side), F.col("n").alias(f"n_{side}"), F.col("wide").alias(f"wide_{side}")), side)
    least = F.least(F.size("wide_a"), F.size("wide_b"))  # sizes of sets that may be alike are within 5/4, so parities are at most twice as many
    half = lambda x: F.when(F.size(x) > least, F.zip_with(F.slice(x, 1, least), F.slice(x, least + 1, least), lambda p, q: p.bitwiseXOR(q))).otherwise(F.col(x))
    pairs = pairs.where(9 * F.least("n_a", "n_b") >= 4 * (F.col("n_a") + F.col("n_b")))
    apart = F.aggregate(F.zip_with(half("wide_a"), half("wide_b"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x)
    return pairs.where(9 * apart <= F.col("n_a") + F.col("n_b")).select("a", "b")


def in_blocks(prints: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of sets whose fingerprints simhash.near_links links, by one set of each fingerprint; and of each other set with that one."""
    heads = materialise(prints.groupBy("print").agg(F.min("fp").alias("head"), F.count(F.lit(1)).alias("sets")), "copies-prints")
    links = near_prints(heads.select(F.col("print").alias("fp")))
    for side in ("a", "b"):
        links = links.join(heads.select(F.col("print").alias(side), F.col("head").alias(f"_{side}")), side)
    same = prints.join(heads.where("sets > 1"), "print").where("fp <> head").select("head", "fp")
    pairs = links.select("_a", "_b").union(same).toDF("a", "b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def verified(docs: DataFrame, prints: DataFrame, pairs: DataFrame, label: str) -> DataFrame:
    """Those of pairs(a, b) whose sets are alike, written; docs, prints(fp, first): the texts and a document that has each set.

    Each b's set goes to its a, and a's set to as many tasks as its partners need (CELL of them in one).
    """
    wanted = pairs.select(F.col("a").alias("fp")).union(pairs.select(F.col("b").alias("fp"))).distinct()
    holders = _few(materialise(prints.join(wanted, "fp", "left_semi").select(F.col("first").alias("_id")).distinct(), f"{label}-holders"))

    def hashes(batches):
        for b in batches:
            for t in b.column(1).to_pylist():
                h = shingles(t or b"")
                yield pa.RecordBatch.from_arrays([pa.array([key_of(h)], pa.int64()), pa.array([h.tobytes()], pa.binary())], ["fp", "hashes"])

    held = narrow(docs).join(holders, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    found = map_in_arrow(held, hashes, "fp long, hashes binary").join(wanted, "fp", "left_semi")
    sets = materialise(found.groupBy("fp").agg(F.first("hashes").alias("hashes")), f"{label}-sets", "uncompressed")
    cells = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / CELL).cast("long").alias("cells"))
    partners = pairs.join(cells, "a").select("a", F.pmod(F.xxhash64("b"), "cells").alias("cell"), F.col("b").alias("fp"))
    own = cells.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)).alias("cell"), F.col("a").alias("fp"))
    whole = own.withColumn("second", F.lit(0)).union(partners.withColumn("second", F.lit(1))).join(sets, "fp").select("a", "cell", "second", "fp", "hashes")

    def verify(batches):
        mine = None
        for b in slices(batches):
            out = []
            for a, second, fp, raw in zip(*[b.column(k).to_pylist() for k in (0, 2, 3, 4)]):
                found = np.frombuffer(raw, "<u8")
                if not second:
                    mine = found
                elif alike(mine, found):
                    out.append((a, fp))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = whole.repartition(parts, "a", "cell").sortWithinPartitions("a", "cell", "second")
    return materialise(map_in_arrow(dealt, verify, "a long, b long"), f"{label}-links")


def near_links(docs: DataFrame, prints: DataFrame) -> DataFrame:
    """Links (a, b) that connect all sets of docs that are alike; prints: distinct_sets.

    First sets that SimHash blocks bring together are compared, and each set with one star of each draw
    alone, that of most of its buckets, which makes most of a large group one component. Then members
    that are still in different components are compared, so no link between components is lost and a
    group's pairs are never listed.
    """
    shared = materialise(buckets(prefixes(docs, *common_shingles(docs))), "copies-buckets")
    met = shared.select("fp", F.posexplode(F.array(*_STARS)).alias("draw", "star")).where("star <> fp").groupBy("fp", "draw", "star").agg(F.count(F.lit(1)).alias("n"))
    best = met.groupBy("fp", "draw").agg(F.max(F.struct("n", "star")).alias("best"))
    drawn = best.select(F.least("fp", "best.star").alias("a"), F.greatest("fp", "best.star").alias("b"))
    stars = materialise(drawn.union(in_blocks(prints)).distinct(), "copies-stars")
    first = verified(docs, prints, materialise(possible(stars, prints), "copies-possible"), "copies-stars")
    labels = connected_components(first, "copies-stars").select(F.col("node").alias("fp"), "component")
    named = _few(materialise(prints.join(labels, "fp", "left").select("fp", F.coalesce("component", "fp").alias("label"), *_PARITIES), "copies-labels"))
    labelled = shared.join(named, "fp").select("sh", "fp", "n", "pos", "part", "label", *_PARITIES)
    rest = crossing(labelled).join(stars, ["a", "b"], "left_anti")
    found = verified(docs, prints, materialise(possible(rest, prints), "copies-crossing"), "copies-crossing")
    for side in ("a", "b"):  # between components one link is enough
        found = found.join(named.select(F.col("fp").alias(side), F.col("label").alias(f"_{side}")), side)
    return labels.where("fp <> component").select("fp", "component").union(found.select("_a", "_b").distinct()).toDF("a", "b")


def near_groups(docs: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp, class, component_id (the smallest doc_id reachable by links) of every row; also: columns of longs that go along."""
    own = materialise(set_keys(docs, also), "copies-keys")
    prints = distinct_sets(own)
    return groups_of(own.drop("n", "print", "wide", *_PARITIES), prints.select("fp", "first"), near_links(docs, prints), "copies")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each group, as simhash.keep_first; columns as they came."""
    keyed = with_row_key(docs)
    return keep_first(keyed, near_groups(keyed, ROW_KEY))
