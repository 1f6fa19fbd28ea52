"""Near copies of the pipeline against all pairs."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gondola.llm import near_copies
from tests.llm.test_documents import SCHEMA, components


def shingle_set(text):
    found = (text or "").lower().split()
    return {tuple(found[k : k + 5]) for k in range(max(len(found) - 4, 1))} if found else set()


def brute_groups(rows):
    sets = {r[0]: shingle_set(r[1]) for r in rows}
    ids = sorted(sets)
    same = lambda a, b: 10 * len(a & b) >= 8 * len(a | b)
    return components([(a, b) for a in ids for b in ids if a < b and same(sets[a], sets[b])], ids)


def near_documents():
    r = random.Random(5)
    plain = " ".join(f"notice{i}" for i in range(30))  # a passage that most texts share
    rows = []
    for i in range(60):
        own = [f"w{r.randrange(5000)}" for _ in range(40 + r.randrange(80))]
        rows.append((10 * i, plain + " " + " ".join(own), "en", "s", 0))
        for k in range(1, 6):  # more and more words changed: similarities on both sides of 0.8
            other = list(own)
            for at in r.sample(range(len(own)), k):
                other[at] = f"x{r.randrange(5000)}"
            rows.append((10 * i + k, plain + " " + " ".join(other), "en", "s", 0))
    nothing = [(2000, None, "en", "s", 0), (2001, " ", "en", "s", 0), (2002, "Two words", "en", "s", 0), (2003, "two  WORDS", "en", "s", 0), (2003, "two  WORDS", "en", "s", 0)]
    return rows + nothing


def test_near_copies_equal_all_pairs(spark):
    rows = near_documents()
    want = brute_groups(rows)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {x["doc_id"]: x["component_id"] for x in near_copies.near_groups(docs).collect()}
    assert got == want and 60 < len(set(want.values())) < len(want) - 60


def test_the_stage_drops_near_copies(spark):
    import corpus_pipeline

    rows = near_documents()
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    kept = sorted(x["doc_id"] for x in stage(spark, spark.createDataFrame(rows, SCHEMA), "").collect())
    assert kept == sorted(set(brute_groups(rows).values()))


def test_rows_without_an_id_of_their_own_stay(spark):
    """Null and repeated ids with different texts: one row a group, compared as whole rows."""
    from pyspark.sql import functions as F

    from gondola.llm import simhash

    text = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(None, text("a"), "x"), (None, text("b"), "x"), (7, text("c"), "x"), (7, text("d"), "x"), (8, text("e"), "x"), (9, text("e"), "x"), (8, text("e"), "y"), (8, text("e"), "x"), (None, text("a"), "x"), (None, text("a"), None), (10, None, "x"), (11, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit("clash") for c in ("class", "_stays", "n", "fp", "first", "_first")}).repartition(3)
    for module in (near_copies, simhash):
        out = module.drop_near_copies(docs)
        assert out.columns == docs.columns
        got = [(r["doc_id"], r["text"]) for r in out.collect()]
        assert sorted(got, key=repr) == sorted([(None, text("a")), (None, text("b")), (7, text("c")), (7, text("d")), (8, text("e")), (10, None)], key=repr)


def test_a_large_group_lists_few_pairs(spark):
    """Of a group of near copies only stars are compared; copies that are alike to no star are found by the rest."""
    r = random.Random(9)
    base = [f"b{k}" for k in range(120)]
    rows = [(0, " ".join(base), "en", "s", 0)]
    for i in range(1, 300):
        other = list(base)
        for at in r.sample(range(120), r.randrange(1, 5)):
            other[at] = f"y{i}x{at}"
        rows.append((i, " ".join(other), "en", "s", 0))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {x["doc_id"]: x["component_id"] for x in near_copies.near_groups(docs).collect()}
    assert got == brute_groups(rows)
    own = near_copies.materialise(near_copies.set_keys(docs), "test")
    links = near_copies.near_links(docs, near_copies.distinct_sets(own))
    assert links.count() < 300 * 20


def test_many_unlike_sets_share_a_prefix_shingle(spark):
    """50,000 short texts of one frame, unlike but for planted copies: no task holds more than two parts."""
    n, frame = 50_000, "the same frame of words stands around every one of these"
    rows = [(i, f"first{i} second{i} third{i} {frame}", "en", "s", 0) for i in range(n)]
    planted = {i: i + 1 for i in range(0, n, 5000)}  # only the last words of two long texts differ
    long = lambda i, end: f"{' '.join(f'w{i}x{k}' for k in range(30))} {frame} {end}"
    for a, b in planted.items():
        rows[a], rows[b] = (a, long(a, "x"), "en", "s", 0), (b, long(a, "y"), "en", "s", 0)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(8)
    prefixes = near_copies.materialise(near_copies.prefixes(docs, np.zeros(0, np.uint64), np.zeros(0, np.int64)), "test")
    shared = near_copies.buckets(prefixes).groupBy("sh", "part").count().collect()
    assert max(r["count"] for r in shared) <= near_copies.TILE and max(r["part"] for r in shared) > 2
    got = {x["doc_id"]: x["component_id"] for x in near_copies.near_groups(docs).collect()}
    back = {b: a for a, b in planted.items()}
    assert got == {i: back.get(i, i) for i in range(n)}


def test_parts_of_a_hot_shingle_meet(spark, monkeypatch):
    """Two sets of different parts are a pair; each pair of parts is a group."""
    bits = {c: 0 for c in near_copies._PARITIES}
    rows = [(1, k, 100, 0, k // 10, k) for k in range(45)] + [(2, k, 100, 0, 0, k % 3) for k in range(9)] + [(3, 7, 100, 0, 0, 7)]
    df = spark.createDataFrame(rows, "sh long, fp long, n long, pos long, part long, label long").withColumns({c: F.lit(v).cast("long") for c, v in bits.items()})
    got = sorted((r["a"], r["b"]) for r in near_copies.crossing(df).collect())
    assert got == [(a, b) for a in range(45) for b in range(a + 1, 45)]


def test_groups_come_in_bounded_parts():
    keys = np.sort(np.random.default_rng(2).choice([1, 2, 2, 2, 2, 2, 3, 4, 4], 500))
    rows = [keys, np.arange(500)]
    for size in (1, 7, 64, 500):
        batches = [pa.RecordBatch.from_arrays([pa.array(c[at : at + size]) for c in rows], ["key", "x"]) for at in range(0, 500, size)]
        for most in (1, 10, 100, None):
            seen = {}
            for part, alone, block in near_copies._groups(iter(batches), 2, most=most):
                key = int(block[0, 0])
                assert (block[0] == key).all() and part == len(seen.setdefault(key, [])) and alone == (most is None or (keys == key).sum() <= most)
                assert most is None or block.shape[1] <= most
                seen[key].append(block[1])
            assert all((np.concatenate(seen[k]) == np.flatnonzero(keys == k)).all() for k in (1, 2, 3, 4))
