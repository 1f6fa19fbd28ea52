"""What the pipeline returns: the packed ids of the masked texts, and which secrets are masked."""

import zlib
from collections import defaultdict

import numpy as np

import corpus_pipeline
from gondola.llm import packing, queries, secret_scan, tokenizing
from tests.llm.test_documents import LONG, SCHEMA, words


def sequences(rows):
    """sequence_id: its ids, of pieces with ids."""
    found = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == len(found[r["sequence_id"]])
        found[r["sequence_id"]] += np.frombuffer(r["ids"], "<u2").tolist()
    return found


def test_the_pipeline_returns_packed_ids_of_masked_texts(spark, tmp_path):
    password = "password=Zq8xLm3v9Tr2"
    rows = [(i, f"{words(i, 40)} and {password if i == 3 else 'nothing'} {words(50 + i, 40)}", "en", f"s{i % 2}", 0) for i in range(12)]
    rows.append((99, " ".join(f"the {x} of" for x in words(7, 9000).split()), "en", "s0", 0))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert all(len(p["ids"]) == 2 * p["length"] and p["ids_crc32"] == zlib.crc32(np.frombuffer(p["ids"], "<u2").astype("<u4").tobytes()) for p in pieces)
    encoder = tokenizing.ChunkEncoder().encoder
    text = "".join(encoder.decode(ids) for ids in sequences(pieces).values())
    assert "[SECRET]" in text and "Zq8xLm3v9Tr2" not in text


def test_checksums_are_of_the_ids_carried_to_the_windows(spark, tmp_path):
    docs = spark.createDataFrame([(1, LONG, "en", "s", 0), (2, words(1, 50), "en", "s", 0)], SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    carried = {r["doc_id"]: r for r in packing.tokens(docs).collect()}
    assert all(len(r["ids"]) == 2 * r["doc_tokens"] for r in carried.values()) and carried[1]["doc_tokens"] > 2 * packing.WINDOW
    for r in queries.op7_lexical_packing(spark, str(tmp_path)).collect():
        ids = np.frombuffer(carried[r["doc_id"]]["ids"], "<u2")[r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == packing.crc_of(ids)


def test_plain_passwords_of_few_owners_are_masked(spark):
    own = ["password=Tr0ub4dr", "secret: correcthorsebattery", "token=12345678", "passwd='aaaaaaaa'", "AKIA" + "A" * 16, "f" * 32]
    rows = [(i, f"before {x} after", "en", "s0", 0) for i, x in enumerate(own)]
    rows += [(10 + i, "use password=changeme1 here", "en", f"s{i}", 0) for i in range(3)]  # three owners: an example
    rows += [(20, "token=abcdefgh and token=abcdefgh12345", "en", "s0", 0), (21, "z" * 30, "en", "s0", 0)]
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redact(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [clean[i] for i in range(6)] == [f"before {x} after" for x in ("password=[SECRET]", "secret: [SECRET]", "token=[SECRET]", "passwd='[SECRET]'", "[SECRET]", "[SECRET]")]
    assert all(clean[10 + i] == "use password=changeme1 here" for i in range(3))
    assert clean[20] == "token=[SECRET] and token=[SECRET]" and clean[21] == "z" * 30
