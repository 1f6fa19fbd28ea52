"""Alignment of two tokenizers: by plain loops over spans, with the JSON vocabulary's own library."""

import hashlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from gondola.llm import alignment, queries

SCHEMA = "doc_id long, text string, pairs string, links string, row string, n_a string"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def byte_level() -> dict[str, int]:
    """The characters that stand for bytes in the JSON vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@pytest.fixture(scope="module")
def brute():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    of = byte_level()

    def spans(tokens):
        ends = np.cumsum([len(t) for t in tokens]).tolist()
        return list(zip([0, *ends], ends))

    def one(text):
        if not text:
            return None
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(of[c] for c in a.id_to_token(i)) for i in ids_a]
        pieces = [b.id_to_piece(i) for i in ids_b]
        bytes_b = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in pieces]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            return None
        spans_a, spans_b = spans(bytes_a), spans(bytes_b)
        cuts = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
        links, j = [], 0
        for i, (s, e) in enumerate(spans_a):
            while spans_b[j][1] <= s:
                j += 1
            k = j
            while k < len(spans_b) and spans_b[k][0] < e:
                links.append((ids_a[i], ids_b[k]))
                k += 1
        groups, begin = [], 0
        for cut in cuts:
            part = lambda ids, where: ",".join(str(x) for x, (s, e) in zip(ids, where) if begin <= s and e <= cut)  # noqa: B023, E731
            groups.append(part(ids_a, spans_a) + "|" + part(ids_b, spans_b))
            begin = cut
        return len(ids_a), len(ids_b), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest()

    def every(rows):
        found = [(d, one(t)) for d, t in rows]
        held = Counter(pair for _, x in found if x for pair in set(x[3]))
        top = {}
        for (i, _), n in held.items():
            top[i] = max(top.get(i, 0), n)
        out = []
        for d, x in found:
            n_best = sum(held[pair] == top[pair[0]] for pair in x[3]) if x else 0
            out.append((d, x[0], x[1], x[2], len(x[3]), n_best, sum(held[pair] for pair in x[3]), x[4]) if x else (d, 0, 0, 0, 0, 0, 0, ""))
        return sorted(out, key=repr)

    return every


ROWS = [
    (1, None), (2, ""), (3, " "), (4, "one"), (5, "one"), (5, "one"), (None, "no id  at all"), (6, "holds ▁ itself"), (7, "<|endoftext|> and <s> </s> <0x41> <unk>"), (8, "tab\tand\nline\r\n\n  end "),
    (9, "ünïcödé 😀😀 ﬁ é 　 \xa0x 漢字 ქართული \x00 ﻿"), (10, "don't  stop\n\n now 1234567 x=y;"), (11, " ".join(f"w{i % 97}x" for i in range(3000))), (12, "a" * 3000), (13, "  " * 500 + "x"),
]


def collect(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def frame(spark, rows):
    """Extra columns have the names that the operator uses itself."""
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SCHEMA)


@pytest.mark.parametrize("most", [alignment.BROADCAST_PAIRS, 40, 0])
def test_awkward_rows(spark, brute, most):
    """Also where some pairs, or all, meet their documents by a shuffle."""
    assert collect(alignment.align(frame(spark, ROWS).repartition(3), broadcast_pairs=most)) == brute(ROWS)


def test_segments_and_steps_change_nothing(spark, brute, monkeypatch):
    whole = sorted(map(repr, alignment.aligned(frame(spark, ROWS)).collect()))
    assert sorted(map(repr, alignment.aligned(frame(spark, ROWS), segment=50).collect())) == whole
    monkeypatch.setattr(alignment, "STEP", 100)
    pair = alignment.Pair()
    found = alignment.Alignment(pair, 1)
    text = ROWS[-3][1]
    parts = pair.encode(text, 200)
    assert len(parts) > 20
    for a, b in parts:
        found.add(0, a, b)
    found.flush()
    ((_, n_a, n_b, n_groups, n_links, *_, sha),) = brute([(1, text)])
    assert found.totals[:, 0].tolist() == [n_a, n_b, n_groups, n_links] and found.shas[0].hexdigest() == sha
    assert int(found.pairs(0)[1].sum()) == n_links


def test_segments_give_the_text_back():
    for text in (ROWS[-3][1], "a b", " a  b c ", "x" * 100, ""):
        for most in (1, 2, 50):
            assert " ".join(alignment.segments(text, most)) == text


def test_no_piece_holds_a_space_after_another_character():
    assert not alignment.Pair().whole


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_tables(spark, brute, sf):
    path = f"/root/testdata/{sf}"
    rows = duckdb.sql(f"select doc_id, text from '{path}/documents.parquet'").fetchall()
    assert collect(queries.queries()["op12_token_alignment"](spark, path)) == brute(rows)


def test_empty_table(spark):
    assert collect(alignment.align(frame(spark, []))) == []
