"""Bottom-k sketches against sets of shingles in Python, and the native queries' plans."""

import hashlib
import random

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from gondola.llm import fingerprint, queries

SCHEMA = "doc_id long, text string, key string, of string, need string, copies string, sketch string, at string, n string"
K = fingerprint.K


def sketch(text, k=K):
    words = (text or "").encode().split()
    parts = [b" ".join(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [b" ".join(words)] * bool(words)
    hashes = {xxhash.xxh64_intdigest(p, seed=42) for p in parts}
    return sorted(h - (1 << 64) if h >> 63 else h for h in hashes)[:k]


def near(a, b, k=K):
    union = sorted({*a, *b})[:k]
    return len(set(union) & set(a) & set(b)) / len(union) if union else 1.0


def printed(a):
    return "".join(f"{h % (1 << 64):016x}" for h in a)


def brute(rows):
    """The rows of one doc_id in the order of their keys."""
    key = lambda r: hashlib.sha256(f"{'null' if r[0] is None else r[0]}:{r[1] or ''}".encode()).digest()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, key(r)))
    out = []
    for i, (doc, text) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        n = len(text) // 4
        new = text[: len(text) - n] + after[:n]
        own = sketch(text)
        out.append((doc, len(text), hashlib.sha256(new.encode()).hexdigest(), printed(own), printed(sketch(new)), near(own, sketch(new)), near(own, sketch(after))))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def collect(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


ROWS = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "one two three four"), (6, "one two three four five"), (7, "a b c d e f g h " * 40), (7, "a b c d e f g h " * 40), (7, "a b c d e f g h " * 40), (7, "other text of seven"),
    (None, "no id at all here now"), (None, "no id at all here now"), (None, None), (8, " ".join(f"w{i}" for i in range(30_000))), (9, "ünïcödé 😀 漢字\xa0x y z  w v u t s" * 9), (-5, "x" * 100), (10, "last of all of them\n"),
]


def run(spark, rows, tmp_path, parts=3):
    """Extra columns have the names that the operator uses itself."""
    spark.createDataFrame([(*r, *["clash"] * 7) for r in rows], SCHEMA).repartition(parts).write.parquet(f"{tmp_path}/documents.parquet")
    return collect(queries.queries()["op13_document_fingerprints"](spark, str(tmp_path)))


def test_awkward_rows(spark, tmp_path):
    assert run(spark, ROWS, tmp_path) == brute(ROWS)


@pytest.mark.parametrize("rows", [[], [(1, "alone with its own text here")], [(1, "same")] * 50, [(None, f"text {k % 7} of a hot null id, it is not long") for k in range(60)]])
def test_few_equal_and_hot_rows(spark, tmp_path, rows):
    assert run(spark, rows, tmp_path) == brute(rows)


def test_whole_table(spark):
    path = "/root/testdata/sf0.01"
    rows = duckdb.sql(f"select doc_id, text from '{path}/documents.parquet'").fetchall()
    assert collect(queries.queries()["op13_document_fingerprints"](spark, path)) == brute(rows)


def test_extra_columns_of_any_name(spark):
    df = spark.createDataFrame([(*r, *["clash"] * 7) for r in ROWS], SCHEMA)
    assert fingerprint.edited(df).count() == len(ROWS)


def test_merging_and_estimates(spark):
    r = random.Random(3)
    texts = [" ".join(r.choice("abcdefghij") + r.choice("klmnop") + str(r.randrange(50)) for _ in range(n)) for n in (3000, 40, 2)]
    texts.append(texts[0][: len(texts[0]) // 2])
    df = spark.createDataFrame([tuple(texts)], "a string, b string, c string, half string").select(*[fingerprint.sketch(F.col(c)).alias(c) for c in ("a", "b", "c", "half")])
    a, b, half = F.col("a"), F.col("b"), F.col("half")
    got = df.select(
        fingerprint.merged(a, b).alias("merged"), fingerprint.distinct_shingles(a).alias("many"), fingerprint.distinct_shingles(b).alias("few"),
        fingerprint.containment(half, a).alias("inside"), fingerprint.containment(a, half).alias("outside"), fingerprint.resemblance(a, half).alias("near"),
    ).first()
    assert got["merged"] == sorted({*sketch(texts[0]), *sketch(texts[1])})[:K]
    assert got["few"] == 36 and 2996 * 0.7 < got["many"] < 2996 * 1.3
    assert got["inside"] > 0.8 and 0.35 < got["outside"] < 0.65 and 0.35 < got["near"] < 0.65


def test_groups_merge_in_rounds(spark):
    """A third of all sketches in one group, some of them copies; null is a group."""
    rows = [(("hot", "cold", None)[k % 3 if k < 90 else 0], f"text number {k % 170} with a few words of its own {k % 170}") for k in range(200)]
    df = spark.createDataFrame(rows, "source string, text string").repartition(5)
    whole = df.select("source", fingerprint.sketch(F.col("text"), k=16).alias("sketch"))
    got = {r["source"]: r["sketch"] for r in fingerprint.merged_by(whole, ["source"], k=16, fan_in=4).collect()}
    assert got == {s: sorted({h for t, x in rows if t == s for h in sketch(x)})[:16] for s in ("hot", "cold", None)}
    assert fingerprint.merged_by(whole.limit(0), ["source"]).count() == 0


@pytest.mark.parametrize("number", [1, 2, 4, 10, 13])
def test_native_queries_run_no_python(spark, number):
    """The last plan of the query; what it writes on its way is held by the check tool."""
    name = next(n for n in queries.queries() if n.startswith(f"op{number}_"))
    plan = queries.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
