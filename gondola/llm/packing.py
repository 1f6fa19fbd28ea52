"""Lexical retrieval packing into fixed windows.

Whole windows of a long document stand alone. The tails (shorter than a window) are range-
partitioned by a locality key, so those that share most of their ids meet, into index shards of
about SHARD_TAILS tails, one a task: a shard is an inverted index with BM25 weights (document
frequencies over the tails of all documents), a seed tail retrieves its unused neighbours by
score, and they fill the seed's window in that order. The last one is cut to fit exactly; its
rest is the next seed. Only the last window of a partition can be padded.

A seed's neighbours are ranked by all of its ids against all unused tails of the shard; as many as
fill the window are handed out, CANDIDATES at a time, and when these are used up the seed asks
again, so none is missed in a shard. Whenever an eighth of an index's tails are used they leave it.

Defined cases: a null text is empty (its only id is the end id); repeated rows are packed each;
null ids stay null; an empty table gives no pieces. Only the named columns are read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import blocks, map_in_arrow, materialise
from gondola.llm.tokenizing import block_encoder, release

WINDOW = 2048
#: Tails of an index shard (about 2,500 bytes each), and up to twice as many where ranges come out uneven.
SHARD_TAILS = 16_384
#: Chunks that a worker keeps the ids of: more take longer to look up than they save.
CACHE_CHUNKS = 200_000
#: Neighbours that a seed is given at a time, and the share of tails (one in so many) over which an id's weights are kept as a row of all tails.
CANDIDATES, COMMON = 384, 10
END_ID = 1
IDS = 1 << 16
K1, B = 1.2, 0.75
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def crc_of(ids: np.ndarray) -> int:
    """CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def _ranks(factor: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each id its place when all are put in hashed order, and the ids in that order."""
    mixed = np.arange(IDS, dtype=np.uint32) * np.uint32(factor)
    order = np.argsort(mixed ^ mixed >> np.uint32(15)).astype(np.uint16)
    place = np.empty(IDS, np.uint16)
    place[order] = np.arange(IDS, dtype=np.uint16)
    return place, order


RANKS = [_ranks(factor) for factor in (2654435761, 2246822519, 3266489917)]


def locality(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Three min-hashes of each stretch of ids, one after the other: texts that share many ids tend to share it; 0 if it is empty."""
    key, some = np.zeros(len(starts), np.int64), np.flatnonzero(starts < ends)
    cuts = np.stack([starts[some], ends[some]], 1).ravel()
    for place, order in RANKS if len(some) else ():
        ranks = np.append(place[flat], np.uint16(0))
        key[some] = key[some] << 16 | order[np.minimum.reduceat(ranks, cuts)[::2]]
    return key


def _tokens(docs: DataFrame, window: int, cache_chunks: int = CACHE_CHUNKS) -> DataFrame:
    """tokens, and rows counted from each task's tails: doc_id an id, doc_tokens how many tails hold it (under -1 the tails, under -2 their ids)."""

    def run(batches):
        encode = block_encoder(cache_chunks=cache_chunks).encode
        end = END_ID.to_bytes(2, "little")
        names = ["doc_id", "doc_tokens", "ids", "near", "counted"]
        df, tails, length = np.zeros(IDS, np.int64), 0, 0
        last = np.zeros(IDS, np.int32)  # of each id the place where the tail has it last
        for b in blocks(batches, 1):
            ids, bounds = encode(b.column(1), end)
            n = np.diff(bounds)
            starts, ends = bounds[1:] - n % window, bounds[1:]
            for tail in (ids[at:to] for at, to in zip(starts.tolist(), ends.tolist())):
                places = np.arange(len(tail), dtype=np.int32)
                last[tail] = places
                df[tail[last[tail] == places]] += 1
            tails += int((starts < ends).sum())
            length += int((ends - starts).sum())
            kept = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(2 * bounds), pa.py_buffer(ids)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), kept, pa.array(locality(ids, starts, ends)), pa.array(np.zeros(len(n), bool))], names)
        seen = np.flatnonzero(df)
        k = len(seen) + 2
        yield pa.RecordBatch.from_arrays([pa.array([*seen, -1, -2], pa.int64()), pa.array([*df[seen], tails, length], pa.int64()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.int64()), pa.array([True] * k)], names)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_in_arrow(narrow, run, "doc_id long, doc_tokens long, ids binary, near long, counted boolean")


def tokens(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, doc_tokens, ids (all of them, 16-bit), near (the tail's locality key)."""
    return _tokens(docs, window).where("not counted").drop("counted")


def _tail(raw: bytes, doc_tokens: int, window: int) -> np.ndarray:
    ids = np.frombuffer(raw, "<u2")
    return ids[len(ids) - doc_tokens % window :]


def frequencies(counted: DataFrame) -> tuple[np.ndarray, int, float]:
    """Of all tails: document frequency by id (as many numbers as the vocabulary has), how many, mean length; counted: those rows of _tokens."""
    found = {r["id"]: r["n"] for r in counted.groupBy(F.col("doc_id").alias("id")).agg(F.sum("doc_tokens").alias("n")).collect()}
    df = np.zeros(IDS, np.int64)
    for i, n in found.items():
        if i >= 0:
            df[i] = n
    n = found.get(-1, 0)
    return df, n, found.get(-2, 0) / max(n, 1)


def _counted(tails: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each tail the distinct ids, ascending, and how often it holds them."""
    found = []
    for at in range(0, len(tails), 1024):
        part = tails[at : at + 1024]
        key = np.repeat(np.arange(len(part), dtype=np.uint32) << np.uint32(16), [len(t) for t in part]) | np.concatenate(part)
        key.sort()
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        times = np.diff(first, append=len(key)).astype(np.uint16)
        cuts = np.searchsorted(key[first], np.arange(len(part) + 1, dtype=np.int64) << 16).tolist()
        ids = key[first].astype(np.uint16)
        found += [(ids[a:b], times[a:b]) for a, b in zip(cuts, cuts[1:])]
    return found


class Index:
    """An inverted index over one shard's tails."""

    def __init__(self, counted: list[tuple[np.ndarray, np.ndarray]], lengths: np.ndarray, idf: np.ndarray, mean: float, candidates: int = CANDIDATES):
        """counted: of each tail the distinct ids and how often it holds them; lengths: of the tails."""
        self.candidates, self.n, self.lengths = candidates, len(counted), lengths
        self.left = np.arange(self.n)  # the tails that it still holds
        self.terms = [c[0] for c in counted]
        ids = np.concatenate(self.terms)
        held = np.bincount(ids, minlength=IDS) * COMMON > max(self.n, COMMON)
        # of common ids: a row of weights
        self.row = np.full(IDS, -1)
        self.row[held] = np.arange(held.sum())
        self.common = np.zeros((held.sum(), self.n), np.float32)
        rare = []
        for at in range(0, self.n, 1024):
            part = counted[at : at + 1024]
            sizes = [len(c[0]) for c in part]
            docs, terms, tf = np.repeat(np.arange(at, at + len(part)), sizes), np.concatenate([c[0] for c in part]), np.concatenate([c[1] for c in part]).astype(np.float64)
            weights = idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths.astype(np.float64)[docs] / max(mean, 1)))
            often = held[terms]
            self.common[self.row[terms[often]], docs[often]] = weights[often]
            rare.append((terms[~often], docs[~often], weights[~often]))
        # of the others: the tails and weights of id i are those from starts[i] on
        terms = np.concatenate([r[0] for r in rare])
        order = np.argsort(terms, kind="stable")
        self.docs, self.weights = np.concatenate([r[1] for r in rare])[order], np.concatenate([r[2] for r in rare])[order]
        self.starts = np.searchsorted(terms[order], np.arange(IDS + 1))

    def forget(self, free: np.ndarray) -> None:
        """Only the free tails stay."""
        stays = free[self.left]
        held = stays[self.docs]
        self.starts = np.append(0, np.cumsum(held))[self.starts]
        self.docs, self.weights = (np.cumsum(stays) - 1)[self.docs[held]], self.weights[held]
        self.common = self.common.compress(stays, axis=1)
        self.left = self.left[stays]

    def _all(self, terms: np.ndarray) -> np.ndarray:
        """Of every tail that is left, the score."""
        spans = [(a, b) for a, b in zip(self.starts[terms].tolist(), self.starts[terms.astype(np.int64) + 1].tolist()) if a < b]
        rows = self.row[terms]
        total = np.zeros(len(self.left), np.float32)
        for k in rows[rows >= 0].tolist():
            total += self.common[k]
        if not spans:
            return total
        return total + np.bincount(np.concatenate([self.docs[a:b] for a, b in spans]), np.concatenate([self.weights[a:b] for a, b in spans]), len(self.left))

    def scores(self, terms: np.ndarray, tails: np.ndarray) -> np.ndarray:
        """BM25 of those tails for a seed's distinct ids."""
        return self._all(terms)[np.searchsorted(self.left, tails)]

    def nearest(self, terms: np.ndarray, free: np.ndarray, room: int | None = None) -> np.ndarray:
        """The best of the free tails, best first: as many as candidates, or as it takes to fill the room."""
        score, best = self._all(terms), []
        score[~free[self.left]] = -np.inf
        while len(best) < self.candidates and (room is None or room > 0):
            k = score.argmax()
            if score[k] == -np.inf:
                break
            score[k] = -np.inf
            best.append(self.left[k])
            if room is not None:
                room -= self.lengths[best[-1]]
        return np.array(best, np.int64)


def _packer(window: int, idf: np.ndarray, mean: float, with_ids: bool, shard_tails: int, candidates: int):
    """Packs a partition's rows as one shard (more, if there are far more tails than a shard has); the open window goes on into the next shard."""

    def run(batches):
        release()  # all texts have been encoded
        base = TaskContext.get().partitionId() << 32
        state = {"seq": 0, "used": 0, "terms": None}
        names = [f.split()[0] for f in PIECES.split(", ")] + ["ids"] * with_ids

        def batch(out):
            columns = [pa.array([o[k] for o in out], pa.int64()) for k in range(7)]
            return pa.RecordBatch.from_arrays(columns + ([pa.array([o[7] for o in out], pa.binary())] if with_ids else []), names)

        def fill(rows, out):
            free, nxt, unused = np.ones(len(rows), bool), 0, len(rows)
            lengths = np.array([len(r[2]) for r in rows])
            index = Index(_counted([r[2] for r in rows]), lengths, idf, mean, candidates)

            def place(k, at, n):
                doc, total, tail = rows[k]
                cut = tail[at : at + n]
                start = total - len(tail) + at
                out.append((doc, start, n, crc_of(cut), total, base + state["seq"], state["used"]) + ((cut.tobytes(),) if with_ids else ()))
                state["used"] += n
                if state["used"] == window:
                    state.update(seq=state["seq"] + 1, used=0)

            while unused:
                if 8 * unused < 7 * len(index.left) and len(index.left) > candidates:
                    index.forget(free)
                if not state["used"]:  # a new window: the next unused tail seeds it
                    while not free[nxt]:
                        nxt += 1
                    free[nxt] = False
                    unused -= 1
                    state["terms"] = index.terms[nxt]
                    place(nxt, 0, lengths[nxt])
                    continue
                room = window - state["used"]
                ranked = index.nearest(state["terms"], free, room)
                fits = int(np.searchsorted(np.cumsum(lengths[ranked]), room, side="right"))
                for k in ranked[:fits]:
                    free[k] = False
                    place(k, 0, lengths[k])
                unused -= fits
                if fits < len(ranked) and state["used"]:  # cut the next one; its rest seeds the next window
                    k = ranked[fits]
                    free[k] = False
                    unused -= 1
                    n = window - state["used"]
                    place(k, 0, n)
                    state["terms"] = index.terms[k]
                    place(k, n, lengths[k] - n)

        rows, out = [], []
        for b in batches:
            for doc, total, raw, _ in zip(*[b.column(k).to_pylist() for k in range(4)]):
                tail = _tail(raw, total, window)
                for k in range(total // window):  # whole windows take sequences of their own, counted from the other end
                    ids = raw[2 * k * window : 2 * (k + 1) * window]
                    state["whole"] = state.get("whole", 0) + 1
                    crc = crc_of(np.frombuffer(ids, "<u2"))
                    out.append((doc, k * window, window, crc, total, base + (1 << 32) - state["whole"], 0) + ((ids,) if with_ids else ()))
                if len(tail):
                    rows.append((doc, total, tail.copy()))
                if len(rows) == 2 * shard_tails:
                    fill(rows, out)
                    rows = []
                if len(out) >= 4096:
                    yield batch(out)
                    out = []
        if rows:
            fill(rows, out)
        if out:
            yield batch(out)

    return run


def pack(docs: DataFrame, window: int = WINDOW, with_ids: bool = False, shard_tails: int = SHARD_TAILS, candidates: int = CANDIDATES, cache_chunks: int = CACHE_CHUNKS) -> DataFrame:
    """The pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; with_ids: and their ids (16-bit, binary).

    cache_chunks: of texts, that a worker keeps the ids of; fewer take less memory and more time.
    """
    written = materialise(_tokens(docs, window, cache_chunks), "packing-tokens", "zstd")
    df, n, mean = frequencies(written.where("counted"))
    cut = written.where("not counted").drop("counted")
    idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
    parts = max(1, math.ceil(n / shard_tails))
    order = ["near", "doc_id", "doc_tokens", "ids"]
    near = cut.repartitionByRange(parts, "near", "doc_id").sortWithinPartitions(*order)
    return map_in_arrow(near, _packer(window, idf, mean, with_ids, shard_tails, candidates), PIECES + ", ids binary" * with_ids)
