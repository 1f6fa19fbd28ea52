"""Alignment of two tokenizers over the same bytes, by byte-owner arrays.

Each byte of a text is owned by one token of A and one of B (np.repeat of the tokens' numbers over
their lengths). Where the pair of owners changes, two tokens begin to overlap; where both change
at once, both tokenizers cut, and the tokens between two such cuts are a group. How often two ids
overlap is counted in documents: each task lists a document's distinct pairs of ids, Spark counts
them, and joins the counts back. A table of up to BROADCAST_PAIRS pairs is broadcast. Of a larger
one the most frequent pairs are, so that no pair that many documents hold is a join key; the
others meet their documents by a shuffle.

A text longer than SEGMENT code points is encoded in pieces, cut at single spaces between two
characters that are no white space. Neither tokenizer joins anything across such a space: A's
pre-tokenizer begins a piece there, and no piece of B holds a space after another character (B's
vocabulary is looked through for that; else texts stay whole).

Defined cases: texts null, empty, or that a tokenizer doesn't give back byte for byte have no
tokens (zeros, an empty hash) and hold no pair; repeated rows count as documents each; null ids
stay null; an empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gondola.llm.common import map_in_arrow, materialise, slices
from gondola.llm.tokenizing import ChunkEncoder, vocabulary_path

PIECE_MODEL = "piece_bpe_32k.model"
#: Code points encoded at once.
SEGMENT = 500_000
#: Bytes aligned at once (about 30 bytes of arrays each).
STEP = 1 << 20
#: Pairs of ids broadcast at most (about 40 bytes each).
BROADCAST_PAIRS = 1_000_000
_CUT = re.compile(r"(?<=\S) (?=\S)")
COUNTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def segments(text: str, most: int = SEGMENT) -> list[str]:
    """Pieces of about that many characters that stand with a single space between them."""
    found, start = [], 0
    while len(text) - start > most and (m := _CUT.search(text, start + most)):
        found.append(text[start : m.start()])
        start = m.end()
    return [*found, text[start:]]


class Pair:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, byte_path: str | None = None, piece_path: str | None = None):
        import sentencepiece

        self.a = ChunkEncoder(byte_path, specials=False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path or vocabulary_path(PIECE_MODEL))
        self.bytes_a = self.a.token_bytes()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) and self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.whole = any(re.search("[^▁]▁", p) for p in pieces)
        self.len_a, self.len_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.n_b = len(pieces)
        if len(self.bytes_a) * self.n_b >= 1 << 31 or max(len(self.bytes_a), self.n_b) > 1 << 16:
            raise ValueError("a pair of ids must fit 31 bits")
        self.said = [b"%d%b" % (i, sep) for i in range(max(len(self.bytes_a), self.n_b)) for sep in (b",", b"|", b";")]

    def encode(self, text: str | None, most: int = SEGMENT) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A (of space + text) and of B (which adds the space) by segment; none if bytes are not given back."""
        found = []
        for part in [] if not text else [text] if self.whole else segments(text, most):
            a, b = np.frombuffer(self.a.encode(" " + part), "<u2"), np.frombuffer(array("H", self.b.encode(part)), "<u2")
            raw = b" " + part.encode()
            if any(b"".join(map(table.__getitem__, ids.tolist())) != raw for table, ids in ((self.bytes_a, a), (self.bytes_b, b))):
                return []
            found.append((a, b))
        return found


class Alignment:
    """What documents' units (ids of A, ids of B, of the same bytes each) add up to."""

    def __init__(self, pair: Pair, documents: int):
        self.pair = pair
        self.totals = np.zeros((4, documents), np.int64)
        self.shas = [None] * documents
        self.found = [[] for _ in range(documents)]
        self.units, self.held = [], 0

    def add(self, doc: int, a: np.ndarray, b: np.ndarray) -> None:
        self.units.append((doc, a, b))
        self.held += int(self.pair.len_a[a].sum())
        if self.held >= STEP:
            self.flush()

    def flush(self) -> None:
        if not self.units:
            return
        docs = np.array([u[0] for u in self.units])
        a, b = (np.concatenate([u[k] for u in self.units]) for k in (1, 2))
        n_a, n_b = (np.array([len(u[k]) for u in self.units]) for k in (1, 2))
        self.units, self.held = [], 0
        owner_a = np.repeat(np.arange(len(a), dtype=np.int32), self.pair.len_a[a])
        owner_b = np.repeat(np.arange(len(b), dtype=np.int32), self.pair.len_b[b])
        new_a, new_b = (np.concatenate(([True], o[1:] != o[:-1])) for o in (owner_a, owner_b))
        at = np.flatnonzero(new_a | new_b)  # bytes whose pair of owners is another than the byte's before
        link_a, link_b, cut = owner_a[at], owner_b[at], (new_a & new_b)[at]
        group, doc = np.cumsum(cut) - 1, np.repeat(docs, n_a)[link_a]
        for k, of in enumerate((np.repeat(docs, n_a), np.repeat(docs, n_b), doc[cut], doc)):
            self.totals[k] += np.bincount(of, minlength=self.totals.shape[1])
        self._write_groups(docs, a, b, n_a + n_b, group[new_a[at]], group[new_b[at]])
        size = len(self.pair.bytes_a) * self.pair.n_b
        keys, links = np.unique(doc * size + a[link_a].astype(np.int64) * self.pair.n_b + b[link_b], return_counts=True)
        for d, codes, n in zip(np.unique(keys // size).tolist(), *(np.split(x, np.flatnonzero(np.diff(keys // size)) + 1) for x in (keys % size, links)), strict=True):
            self.found[d].append((codes, n))

    def _write_groups(self, docs, a, b, sizes, group_a, group_b) -> None:
        """Add the units' tokens to their documents' hashes, by group, A's before B's."""
        in_a, in_b = np.bincount(group_a), np.bincount(group_b)
        last_a, last_b = (np.append(g[1:] != g[:-1], True) for g in (group_a, group_b))
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]] = a.astype(np.int64) * 3 + last_a
        order[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = b.astype(np.int64) * 3 + 2 * last_b
        ends = np.cumsum(sizes)
        for d, begin, end in zip(docs.tolist(), (ends - sizes).tolist(), ends.tolist(), strict=True):
            if self.shas[d] is None:
                self.shas[d] = hashlib.sha256()
            else:
                self.shas[d].update(b";")
            self.shas[d].update(b"".join(map(self.pair.said.__getitem__, order[begin:end].tolist()))[:-1])

    def pairs(self, doc: int) -> tuple[np.ndarray, np.ndarray]:
        """The document's distinct pairs of ids (a * n_b + b) and their links."""
        parts = self.found[doc]
        if len(parts) < 2:
            return parts[0] if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return codes, np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)


_pairs: dict[tuple, Pair] = {}


def worker_pair(byte_path: str | None, piece_path: str | None) -> Pair:
    """This worker's tokenizers, built once."""
    key = (byte_path, piece_path)
    if key not in _pairs:
        _pairs[key] = Pair(*key)
    return _pairs[key]


def aligned(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None, segment: int = SEGMENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs (distinct, a * size of B + b), links (of each) of every row of docs(doc_id, text)."""

    def run(batches):
        pair = worker_pair(byte_path, piece_path)
        for batch in slices(batches):
            found = Alignment(pair, batch.num_rows)
            for k, text in enumerate(batch.column(1)):
                for a, b in pair.encode(text.as_py(), segment):
                    found.add(k, a, b)
            found.flush()
            pairs = [found.pairs(k) for k in range(batch.num_rows)]
            offsets = pa.array(np.cumsum([0, *(len(p[0]) for p in pairs)]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([p[k] for p in pairs]), pa.int32())) for k in (0, 1)]
            shas = pa.array(["" if s is None else s.hexdigest() for s in found.shas], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, found.totals), shas, *lists], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_in_arrow(narrow, run, f"{COUNTS}, pairs array<int>, links array<int>")


def pair_counts(rows: DataFrame, n_b: int) -> DataFrame:
    """pair, n (documents that hold it), best (whether no pair of the same A id has more) of rows(pairs)."""
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("_a", F.floor(F.col("pair") / n_b))
    tops = counts.groupBy("_a").agg(F.max("n").alias("_top"))
    return counts.join(tops, "_a").select("pair", "n", (F.col("n") == F.col("_top")).alias("best"))


def _met(held: DataFrame, counts: DataFrame, most: int) -> DataFrame:
    """held(row, pair, links) with n and best; see above."""
    if counts.count() <= most:
        return held.join(F.broadcast(counts), "pair")
    # how many pairs each count has: as many rows as there are different counts
    sizes = F.sum("size").over(Window.partitionBy(F.lit(0)).orderBy(F.col("n").desc()))
    by_count = counts.groupBy("n").agg(F.count(F.lit(1)).alias("size")).withColumn("upto", sizes)
    least = by_count.where(F.col("upto") <= most).agg(F.min("n")).first()[0]
    if least is None:
        return held.join(counts, "pair")
    often = held.join(F.broadcast(counts.where(F.col("n") >= least).withColumnRenamed("pair", "_pair")), F.col("pair") == F.col("_pair"), "left").drop("_pair")
    rest = often.where("n IS NULL").select("row", "pair", "links").join(counts.where(F.col("n") < least), "pair")
    return often.where("n IS NOT NULL").unionByName(rest)


def align(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Every row of docs(doc_id, text) with n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    import sentencepiece

    n_b = sentencepiece.SentencePieceProcessor(model_file=piece_path or vocabulary_path(PIECE_MODEL)).get_piece_size()
    rows = materialise(aligned(docs, byte_path, piece_path).withColumn("row", F.monotonically_increasing_id()), "alignment", "zstd")
    counts = materialise(pair_counts(rows, n_b), "alignment-pairs")
    held = rows.select("row", F.inline(F.arrays_zip("pairs", "links"))).withColumnRenamed("pairs", "pair")
    sums = _met(held, counts, broadcast_pairs).groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("n")).alias("count_sum"))
    return rows.drop("pairs", "links").join(sums, "row", "left").fillna(0, ["n_best", "count_sum"]).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

