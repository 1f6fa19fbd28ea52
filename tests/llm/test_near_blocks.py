"""The near copies' SimHash blocks and parities."""

import numpy as np

from gondola.llm import near_copies, simhash
from tests.llm.test_documents import SCHEMA
from tests.llm.test_near_copies import brute_groups, near_documents


def test_blocks_bring_near_copies_together(spark, monkeypatch):
    """SimHash blocks link sets within two bits; what they don't find the prefix join does."""
    docs = spark.createDataFrame(near_documents(), SCHEMA).repartition(3)
    prints = near_copies.distinct_sets(near_copies.materialise(near_copies.set_keys(docs), "test"))
    bits = {r["fp"]: r["print"] for r in prints.collect()}
    met = {(r["a"], r["b"]) for r in near_copies.in_blocks(prints).collect()}
    want = {(a, b) for a in bits for b in bits if a < b and ((bits[a] ^ bits[b]) & (2**64 - 1)).bit_count() <= simhash.DISTANCE}
    assert met and met <= want and (len(met) == len(want) or len(set(bits.values())) < len(bits))
    asked = []
    blocks = near_copies.in_blocks
    monkeypatch.setattr(near_copies, "in_blocks", lambda p: asked.append(1) or blocks(p))
    got = {x["doc_id"]: x["component_id"] for x in near_copies.near_groups(docs).collect()}
    assert asked and got == brute_groups(near_documents())


def test_long_unlike_sets_are_ruled_out(spark):
    """Parities grow with the set; of two sizes the larger one's are folded."""
    long = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    rows = [(0, long("a", 9000), "en", "s", 0), (1, long("b", 9000), "en", "s", 0), (2, long("c", 4000), "en", "s", 0), (3, long("c", 4200), "en", "s", 0), (4, long("d", 4090), "en", "s", 0), (5, long("e", 4300), "en", "s", 0)]
    own = near_copies.materialise(near_copies.set_keys(spark.createDataFrame(rows, SCHEMA)), "test")
    fp = {r["doc_id"]: r["fp"] for r in own.collect()}
    pairs = spark.createDataFrame([(fp[a], fp[b]) for a in fp for b in fp if a < b], "a long, b long")
    left = {(r["a"], r["b"]) for r in near_copies.possible(pairs, near_copies.distinct_sets(own)).collect()}
    assert left == {(fp[2], fp[3])}
    assert len(near_copies.parities(np.zeros(0, np.uint64))[0]) == 16
