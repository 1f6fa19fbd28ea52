"""Training-order materialisation.

All texts, an end id after each, are one stream of ids, in the order of the stored table (its files
by name, their rows as they lie), and each SEQUENCE_TOKENS of it are a sequence; only the last is
shorter. A keyed Feistel permutation with cycle-walking maps a sequence's index to its global slot.
Sequences are range-partitioned by slot and written as fixed-stride shards: record i of a shard
starts at byte i * stride, so a reader resumes at any slot by its shard's name and one offset.

Partitions tokenise their part of the files into blocks; the driver adds up the ids of each split of
a file (one row a split), so each block knows its place in the whole stream and is cut there. Order,
cuts and shards therefore depend on the table and the parameters alone, not on how the table is
split or how many partitions a shuffle has. Sequences that two partitions share are put together by
an exchange of these alone. A DataFrame without files is first written in the order of doc_id.

Ids are compressed in the blocks and in the exchange: as ranks by frequency in a sample,
RANK_ROWS rows of each partition of RANK_FILES files (any ids can be coded whatever the sample), common ones in one byte; the shards hold them plain.

Defined cases: a null text is empty and adds the end id only; repeated rows are each in the
stream; null ids stay null; an empty table gives no sequences and no shards. Only the named
columns are read, so extra ones can't clash.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.llm.common import map_in_arrow, materialise, ship, slices
from gondola.llm.tokenizing import worker_encoder

SEQUENCE_TOKENS = 2048
#: A shard has a 64th of all sequences, but so many at least and at most (134 MB at 2048 ids): it is sorted and written by one task.
SHARD_LEAST, SHARD_MOST = 1024, 32_768
#: Ids of a block of the stream.
BLOCK_IDS = 1 << 18
#: Rows whose ids' frequencies order the codes: the first so many of each partition of so many files.
RANK_ROWS, RANK_FILES = 64, 4
#: A table of splits up to this many (about 150 bytes each) is broadcast; a larger one is joined by shuffle.
BROADCAST_SPLITS = 200_000
KEY = 0x9E3779B97F4A7C15
ROUNDS = 6
END_ID = 1
_ONE, _TWO = 160, 160 + 80 * 256
_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    x = (x ^ np.uint64(key & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def feistel_slots(index: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """The permutation of 0..n-1 at the given indexes: a balanced Feistel network on the next even power of two, walked until below n."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    low, shift = np.uint64((1 << half) - 1), np.uint64(half)
    out = index.astype(np.uint64)
    todo = np.ones(len(out), bool)
    while todo.any():
        x = out[todo]
        left, right = x >> shift, x & low
        for r in range(ROUNDS):
            left, right = right, left ^ (_mix(right, key + r * 0x632BE59BD9B4E019) & low)
        out[todo] = (left << shift) | right
        todo = out >= n
    return out.astype(np.int64)


class Codec:
    """16-bit ids as ranks: one byte below _ONE, two below _TWO, else three; the bytes by their place, then zstd."""

    def __init__(self, order: np.ndarray):
        self.order = order.astype(np.uint16)  # rank -> id
        self.rank = np.empty(1 << 16, np.int64)
        self.rank[order] = np.arange(1 << 16)
        self.key = zlib.crc32(self.order.tobytes()).to_bytes(4, "little")

    def encode(self, raw: bytes) -> bytes:
        r = self.rank[np.frombuffer(raw, "<u2")]
        first = np.where(r < _ONE, r, np.where(r < _TWO, _ONE + ((r - _ONE) >> 8), 240 + ((r - _TWO) >> 16))).astype(np.uint8)
        two = r[r >= _ONE]
        three = two[two >= _TWO] - _TWO
        second = ((two - np.where(two < _TWO, _ONE, _TWO)) & 255).astype(np.uint8)
        third = (three >> 8).astype(np.uint8)
        return self.key + len(r).to_bytes(4, "little") + zstandard.compress(first.tobytes() + second.tobytes() + third.tobytes(), 3)

    def decode(self, code: bytes) -> bytes:
        assert code[:4] == self.key, "coded with another order"
        n = int.from_bytes(code[4:8], "little")
        plain = np.frombuffer(zstandard.decompress(code[8:]), np.uint8).astype(np.int64)
        first = plain[:n]
        big = first >= _ONE
        huge = first[big] >= 240
        m = int(big.sum())
        second, third = plain[n : n + m], plain[n + m :]
        rest = np.where(huge, _TWO, _ONE + ((first[big] - _ONE) << 8)) + second
        rest[huge] += third << 8
        r = first.copy()
        r[big] = rest
        return self.order[r].astype("<u2").tobytes()


_codecs: dict[bytes, Codec] = {}


def codec_of(docs: DataFrame) -> Codec:
    """A codec by the ids of the first rows of some files, which alone are read; known to plain_ids from then on."""

    def run(batches):
        encode, n = worker_encoder().encode, np.zeros(1 << 16, np.int64)
        for b in slices(batches):
            for text in b.column(0).to_pylist():
                n += np.bincount(np.frombuffer(encode(text or ""), "<u2"), minlength=1 << 16)
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(n[seen], pa.int64())], ["id", "n"])

    files = sorted({unquote(f.rpartition("/")[2]) for f in docs.inputFiles()})
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = docs.where(F.col("_metadata.file_name").isin(files[:: max(1, -(-len(files) // RANK_FILES))])).select(F.col("text").cast("string").alias("text"), place.alias("place"))
    counts = np.zeros(1 << 16, np.int64)
    found = map_in_arrow(rows.where(F.col("place") < RANK_ROWS).select("text"), run, "id long, n long")
    for r in found.groupBy("id").agg(F.sum("n").alias("n")).collect():  # as many rows as the vocabulary at most
        counts[r["id"]] = r["n"]
    codec = Codec(np.argsort(-counts, kind="stable"))
    return _codecs.setdefault(codec.key, codec)


def plain_ids(code: bytes) -> bytes:
    """A sequence's ids as 16-bit little-endian integers, of a codec of this process."""
    return _codecs[bytes(code[:4])].decode(code)


@dataclass
class TokenStream:
    """blocks(file, split, at, n_tokens, doc_ids, starts, lengths, ids) and where each (file, split) starts in the stream."""

    blocks: DataFrame
    starts: DataFrame
    total: int
    tokens: int
    codec: Codec


def _in_order(docs: DataFrame) -> DataFrame:
    """docs written in the order of doc_id, then text, and read back."""
    kept = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text"), F.col("text")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialise(kept.repartitionByRange(parts, *order).sortWithinPartitions(*order), "training-documents")


def token_sequences(docs: DataFrame, tokens: int = SEQUENCE_TOKENS, stored: bool = False) -> TokenStream:
    """The stream of docs(doc_id, text), tokenised and written. stored: docs is read straight from files, whose order counts."""
    docs = docs if stored else _in_order(docs)
    codec = codec_of(docs)
    names = ["file", "split", "at", "n_tokens", "doc_ids", "starts", "lengths", "ids"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.binary()]

    def run(batches):
        encode = worker_encoder().encode
        end, width = END_ID.to_bytes(2, "little"), 2 * BLOCK_IDS
        where, at, held, pieces = None, 0, bytearray(), []

        def close():
            nonlocal at, held, pieces
            n = len(held) // 2
            row = [*where, at, n, *map(list, zip(*pieces)), codec.encode(bytes(held))]
            at, held, pieces = at + n, bytearray(), []
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

        for b in slices(batches):
            for doc, text, *here in zip(*[b.column(k).to_pylist() for k in range(4)]):
                if here != where:
                    if held:
                        yield close()
                    where, at = here, 0
                raw, done = encode(text or "") + end, 0
                while done < len(raw):
                    n = min(len(raw) - done, width - len(held))
                    held += raw[done : done + n]
                    pieces.append((doc, done // 2, n // 2))
                    done += n
                    if len(held) == width:
                        yield close()
        if held:
            yield close()

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), "_metadata.file_path", "_metadata.file_block_start")
    schema = "file string, split long, at long, n_tokens long, doc_ids array<bigint>, starts array<bigint>, lengths array<bigint>, ids binary"
    blocks = materialise(map_in_arrow(narrow, run, schema), "training-blocks", "uncompressed")
    sizes = sorted((r["file"], r["split"], r["n"]) for r in blocks.groupBy("file", "split").agg(F.sum("n_tokens").alias("n")).collect())
    starts, total = [], 0
    for file, split, n in sizes:
        starts.append((file, split, total))
        total += n
    where = docs.sparkSession.createDataFrame(starts, "file string, split long, start long")
    return TokenStream(blocks, F.broadcast(where) if len(starts) <= BROADCAST_SPLITS else where, total, tokens, codec)


class _Blocks:
    """The ids of the blocks looked at last."""

    def __init__(self, codec: Codec):
        self.codec, self.known = codec, {}

    def ids(self, code: bytes, a: int, b: int) -> bytes:
        if id(code) not in self.known:
            if len(self.known) > 1:
                self.known.pop(next(iter(self.known)))
            self.known[id(code)] = (code, self.codec.decode(code))
        return self.known[id(code)][1][2 * a : 2 * b]


def _cut(stream: TokenStream, key: int, shard_sequences: int, whole: bool, with_ids: bool):
    """Cuts blocks at the sequences' bounds; whole: gives the sequences of which all is here, else the parts of others."""
    tokens, total, codec = stream.tokens, stream.total, stream.codec
    n = -(-total // tokens)
    names = ["slot", "shard", "record", "place", "n_tokens", "doc_ids", "starts", "lengths", "ids"][: 9 if with_ids else 8]

    def run(batches):
        known, out = _Blocks(codec), []
        at, since, pieces, sources = -1, -1, [], []  # the stream's place, where the open sequence's part starts, what it is of

        def batch():
            slots = feistel_slots(np.array([o[0] for o in out], np.int64), n, key)
            columns = [pa.array(slots), pa.array((slots // shard_sequences).astype(np.int32)), pa.array((slots % shard_sequences).astype(np.int32))]
            columns += [pa.array([o[k] for o in out], pa.int64()) for k in (1, 2)] + [pa.array([o[k] for o in out], pa.list_(pa.int64())) for k in (3, 4, 5)]
            return pa.RecordBatch.from_arrays(columns + ([pa.array([o[6] for o in out], pa.binary())] if with_ids else []), names)

        def close():
            nonlocal pieces, sources, since
            q, length = since // tokens, at - since
            if length and (length == min(tokens, total - q * tokens)) == whole:
                ids = codec.encode(b"".join(known.ids(*x) for x in sources)) if with_ids else None
                out.append((q, since - q * tokens, length, *map(list, zip(*pieces)), ids))
            pieces, sources, since = [], [], at

        for b in slices(batches, 4):
            for start, docs, firsts, lengths, code in zip(*[b.column(k).to_pylist() for k in range(5)]):
                if start != at:
                    close()
                    at = since = start
                for doc, first, left in zip(docs, firsts, lengths):
                    while left:
                        k = min(left, tokens - at % tokens)
                        pieces.append((doc, first, k))
                        if with_ids:
                            if sources and sources[-1][0] is code:
                                sources[-1] = (code, sources[-1][1], at - start + k)
                            else:
                                sources.append((code, at - start, at - start + k))
                        at, first, left = at + k, first + k, left - k
                        if at % tokens == 0:
                            close()
                if len(out) >= 512:
                    yield batch()
                    out.clear()
        close()
        if out:
            yield batch()

    return run


def in_training_order(stream: TokenStream, key: int = KEY, shard_sequences: int | None = None, with_ids: bool = True) -> DataFrame:
    """slot, shard, record (the place in the shard), n_tokens, doc_ids, starts, lengths, ids of every sequence.

    The lists name the pieces of documents in it; starts: the document's ids before the piece. ids:
    compressed binary, see plain_ids. shard_sequences: how many a shard holds; if it isn't given, it
    follows from their number.
    """
    size = shard_sequences or max(SHARD_LEAST, min(SHARD_MOST, -(-stream.total // stream.tokens // 64)))
    codec = stream.codec
    fields = "slot long, shard int, record int, place long, n_tokens long, doc_ids array<bigint>, starts array<bigint>, lengths array<bigint>" + ", ids binary" * with_ids
    placed = stream.blocks.join(stream.starts, ["file", "split"]).select(
        (F.col("start") + F.col("at")).alias("start"), "doc_ids", "starts", "lengths", *(["ids"] if with_ids else [F.lit(None).cast("binary").alias("ids")])
    )
    whole = map_in_arrow(placed, _cut(stream, key, size, True, with_ids), fields)
    parts = map_in_arrow(placed, _cut(stream, key, size, False, with_ids), fields)
    order = F.array_sort(F.collect_list(F.struct("place", "n_tokens", "doc_ids", "starts", "lengths", *["ids"] * with_ids)))
    # as many sequences as there are splits, a few parts each
    met = parts.groupBy("slot", "shard", "record").agg(order.alias("x"))
    lists = [F.flatten(f"x.{c}").alias(c) for c in ("doc_ids", "starts", "lengths")]
    met = met.select("slot", "shard", "record", F.lit(0).cast("long").alias("place"), F.aggregate("x.n_tokens", F.lit(0).cast("long"), lambda a, v: a + v).alias("n_tokens"), *lists, *[F.col("x.ids").alias("ids")] * with_ids)
    if with_ids:

        def joined(batches):
            for b in batches:
                ids = [codec.encode(b"".join(map(codec.decode, codes))) for codes in b.column("ids").to_pylist()]
                yield b.set_column(b.schema.get_field_index("ids"), "ids", pa.array(ids, pa.binary()))

        met = map_in_arrow(met, joined, fields)
    return whole.union(met).drop("place")


def stride(tokens: int = SEQUENCE_TOKENS) -> int:
    """Bytes of a record: its slot (8), its number of ids (2), their CRC-32 (4), the ids padded with zeros, a line feed."""
    return 8 + 2 + 4 + 2 * tokens + 1


def _records(tokens: int, codec: Codec):
    """Fills each sequence's ids up to the fixed width, with the record's head in front."""
    width = 2 * tokens

    def record(slot: int, ids: bytes) -> bytes:
        return slot.to_bytes(8, "little") + (len(ids) // 2).to_bytes(2, "little") + zlib.crc32(ids).to_bytes(4, "little") + ids + bytes(width - len(ids))

    def run(batches):
        for b in slices(batches):
            records = [record(s, codec.decode(code)) for s, code in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(records, pa.binary())], ["shard", "record", "bytes"])

    return run


def write_shards(ordered: DataFrame, path: str, tokens: int = SEQUENCE_TOKENS) -> None:
    """Write in_training_order's rows as raw fixed-stride files, a folder and one file for each shard.

    A shard is a range of slots and a partition's own, sorted by its records: where shards outnumber
    the shuffle partitions, a partition takes several in turn. The files come from Spark's own
    writer, so a lost task's output never shows; bytes pass through its text form unchanged, and
    each record's CRC-32 is compared when it is read.
    """
    known = dict(_codecs)
    parts = int(ordered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = ordered.select("shard", "record", "slot", "ids").repartitionById(parts, "shard")

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield from _records(tokens, known[b.column(3)[0].as_py()[:4]])([b])

    records = map_in_arrow(whole, run, "shard int, record int, bytes binary").sortWithinPartitions("shard", "record")
    lines = records.select("shard", F.col("bytes").cast("string").alias("value"))
    lines.write.partitionBy("shard").option("maxRecordsPerFile", 0).text(path)


def shard_files(spark: SparkSession, path: str, tokens: int = SEQUENCE_TOKENS, from_slot: int = 0) -> list[tuple[str, int]]:
    """(file, bytes) of the shards that hold slots from one on: all but the last hold as many records as the first."""
    files = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/shard=*/part-*")
    found = [(s.getPath().toString(), s.getLen()) for s in files.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(files)]
    found = sorted((int(re.search(r"shard=(\d+)/part-", f)[1]), f, size) for f, size in found)
    records = found[0][2] // stride(tokens) if found else 1
    return [(f, size) for shard, f, size in found if (shard + 1) * records > from_slot]


def read_shards(spark: SparkSession, path: str, tokens: int = SEQUENCE_TOKENS, from_slot: int = 0, with_ids: bool = False) -> DataFrame:
    """slot, n_tokens, ids_crc32 (and ids; with_ids) of all records from a slot on, read from the files.

    Shards below the slot are not opened. Files are split at record boundaries and streamed record
    by record, so a shard's size bounds no task's memory; a record whose ids don't have their CRC-32
    is an error. Spark's reader of fixed-length records is an RDD's; no DataFrame source has one.
    """
    schema = "slot long, n_tokens int, ids_crc32 long" + ", ids binary" * with_ids
    files = shard_files(spark, path, tokens, from_slot)
    if not files:
        return spark.createDataFrame([], schema)  # an empty table leaves no shards

    def run(records):
        for data in records:
            slot = int.from_bytes(data[:8], "little")
            if slot >= from_slot:
                ids = read_record(data, 0, tokens)
                if zlib.crc32(ids.tobytes()) != int.from_bytes(data[10:14], "little"):
                    raise ValueError(f"the record of slot {slot} is damaged")
                yield (slot, len(ids), crc_of(ids)) + ((ids.tobytes(),) if with_ids else ())

    ship(spark)
    names = f"{path}/shard=*/part-*" if from_slot == 0 else ",".join(f for f, _ in files)
    return spark.createDataFrame(spark.sparkContext.binaryRecords(names, stride(tokens)).mapPartitions(run), schema, verifySchema=False)


def read_record(data: bytes, record: int, tokens: int = SEQUENCE_TOKENS) -> np.ndarray:
    """The ids of one record of a shard's bytes."""
    at = record * stride(tokens) + 8
    n = int.from_bytes(data[at : at + 2], "little")
    return np.frombuffer(data, "<u2", n, at + 6)


def crc_of(ids: np.ndarray) -> int:
    """CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def byte_offset(record: Column, tokens: int = SEQUENCE_TOKENS) -> Column:
    return record.cast("long") * stride(tokens)
