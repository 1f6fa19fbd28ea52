"""Many texts encoded at once, and a shard's index as its tails are used up."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from gondola.llm import common, packing, tokenizing

TEXTS = ["", None, " ", "a", "  a", " a b", "a  b", "a b ", "a\n b", "a \nb", "\nfoo bar", "a b\n", "x <|endoftext|> y", "x<|endoftext|>", "a\x1c b", "a b\x85", "a　 b", "a b c", "é ü — 'll don't 12 3,4 ..", "日本 語 🙂 x", "the same words and the same words"]


@pytest.mark.parametrize("cache_chunks", [0, 5, 1000])
def test_a_block_of_texts_has_the_ids_of_each_text(cache_chunks):
    one, many = tokenizing.ChunkEncoder().encoder, tokenizing.BlockEncoder(cache_chunks=cache_chunks)
    for texts in (TEXTS, TEXTS[::-1], TEXTS[-3:], [None, ""], []):
        ids, bounds = many.encode(pa.array(texts, pa.string()), b"\x01\x00")
        assert len(bounds) == len(texts) + 1 and bounds[-1] == len(ids)
        for k, text in enumerate(texts):
            assert ids[bounds[k] : bounds[k + 1]].tolist() == one.encode(text or "", allowed_special="all") + [1], text
        assert len(many.known) == len(many.known_ids) <= max(cache_chunks, 0)


def test_blocks_are_bounded_by_bytes_and_lose_no_row():
    texts = ["aaaa", None, "b" * 50, "", "cc", "dd", "é" * 4, None, "e" * 9, "f" * 9]
    batch = pa.RecordBatch.from_arrays([pa.array(range(10)), pa.array(texts)], ["doc_id", "text"])
    cut = [b.column(1).to_pylist() for b in common.blocks([batch, batch.slice(0, 0)], 1, rows=9, size=10)]
    assert sum(cut, []) == texts
    assert all(len(c) == 1 or sum(len((t or "").encode()) for t in c) <= 10 for c in cut if c[0] != "b" * 50)
    assert ["b" * 50] == [c for c in cut if "b" * 50 in c][0][:1]


def _index(r, n=300):
    tails = [np.concatenate([r.choice(40, 25), 1000 + r.choice(400, 3)]).astype(np.uint16) for _ in range(n)]
    counted = packing._counted(tails)
    for tail, (ids, times) in zip(tails, counted):
        assert all(np.array_equal(a, b) for a, b in zip(np.unique(tail, return_counts=True), (ids, times)))
    held = np.bincount(np.concatenate([c[0] for c in counted]), minlength=packing.IDS)
    return packing.Index(counted, np.array([len(t) for t in tails]), np.log(1 + (n - held + 0.5) / (held + 0.5)), 28.0)


def test_tails_that_leave_the_index_change_no_ranking():
    r = np.random.default_rng(5)
    whole, shrunk = _index(np.random.default_rng(7)), _index(np.random.default_rng(7))
    free = np.ones(300, bool)
    while free.sum() > 20:
        free[r.choice(np.flatnonzero(free), free.sum() // 4, replace=False)] = False
        shrunk.forget(free)
        assert len(shrunk.left) == free.sum() and shrunk.common.shape[1] == free.sum() and shrunk.common.flags.c_contiguous
        for seed in range(0, 300, 30):
            assert whole.nearest(whole.terms[seed], free).tolist() == shrunk.nearest(shrunk.terms[seed], free).tolist()


def test_a_seed_is_given_what_fills_its_window():
    index, free = _index(np.random.default_rng(9)), np.ones(300, bool)
    ranked = index.nearest(index.terms[0], free).tolist()
    assert index.nearest(index.terms[0], free, 1).tolist() == ranked[:1]  # one that is cut
    assert index.nearest(index.terms[0], free, 56).tolist() == ranked[:2]  # two that fit exactly
    assert index.nearest(index.terms[0], free, 57).tolist() == ranked[:3]
    assert index.nearest(index.terms[0], np.zeros(300, bool), 57).tolist() == []


def test_a_shard_takes_little_more_than_its_weights(monkeypatch):
    """A task's own memory while it packs a shard; pieces are given on as they come."""
    r = np.random.default_rng(11)
    ids = [np.sort(r.zipf(1.3, 1500) % 5000).astype("<u2").tobytes() for _ in range(3000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(3000)), pa.array([1500] * 3000), pa.array(ids, pa.binary()), pa.array([0] * 3000)], ["doc_id", "doc_tokens", "ids", "near"])
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    run = packing._packer(2048, np.ones(packing.IDS), 1500.0, False, 16_384, 384)
    tracemalloc.start()
    try:
        pieces = sum(b.num_rows for b in run(batch.slice(k, 500) for k in range(0, 3000, 500)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert pieces >= 3000 and peak < 80e6  # 105 MB where a shard was held as lists of counted tails and built anew, 62 now
