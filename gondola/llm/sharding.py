"""Sharding by histogram sort.

Rows are ordered by (CRC-32 of the text, doc_id), so equal texts lie side by side, and a row whose
smaller keys hold the bytes b of t in all belongs to shard floor(shards * b / t): rows of one key
stay together. The keys at which a shard starts are found by counting exact bytes in bins of leading
digits of the key, across partitions, and refining the bins that hold a wanted boundary until it
stands between two keys. The same rounds cut the shards into cells, one for each shuffle partition
about (within CELL_TOLERANCE of their size, or a single key's); rows are exchanged once, to the
partition of their cell, sorted there and written. The rows below a cell are known from the counts,
so a row's slot follows from its place in its partition, and no task holds a shard. Rows learn their
cell from a broadcast table of the boundaries by their leading digits; MAX_CELLS bounds its size.

Defined cases: a null text is 0 bytes (size 1, CRC-32 0); a null doc_id orders first; rows that
repeat both text and doc_id share a key, stay together and get different slots; an empty table gives no rows;
columns of the input named like an added one (size, text_crc32, shard, slot) are replaced, all others kept.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.llm.common import materialise, shared_path, text_or_empty

#: Digits of a key, and of these how many a round goes further (a bin is cut into 16 ** STEP).
DIGITS, STEP = 24, 2
#: How far from its even place a cell's boundary may stand, as a share of a cell.
CELL_TOLERANCE = 0.25
#: Cells at most (5 GB each of 100 TB): the driver holds a few numbers of each, and about 100 bytes are broadcast.
MAX_CELLS = 20_000
#: What shard adds to a row.
ADDED = ("size", "text_crc32", "shard", "slot")
_SIGN = 1 << 63


def sort_key(doc_id: Column, crc: Column) -> Column:
    """The order as 24 hexadecimal digits: 8 of the CRC-32, 16 of the shifted doc_id."""
    shifted = F.coalesce(doc_id.cast("long"), F.lit(-_SIGN)).bitwiseXOR(F.lit(-_SIGN))
    return F.concat(F.lpad(F.lower(F.hex(crc)), 8, "0"), F.lpad(F.lower(F.hex(shifted)), 16, "0"))


def cell_table(spark: SparkSession, bounds: list[str], about: list[tuple[int, int]]) -> tuple[DataFrame, int]:
    """start, cells: for all keys that begin with those digits the cells they may lie in, as (bound, cell, shard, first); how many digits.

    bounds are sorted; a key's cell is the number of bounds at or below it. about: (shard, first row) of every cell.
    """
    digits = 1
    while 16**digits < len(bounds):
        digits += 1
    rows = []
    for k in range(16**digits):
        start = f"{k:0{digits}x}"
        low, high = bisect_right(bounds, start), bisect_left(bounds, start + "g")
        rows.append((start, [("" if i == low else bounds[i - 1], i, *about[i]) for i in range(low, high + 1)]))
    return F.broadcast(spark.createDataFrame(rows, "start string, cells array<struct<bound:string,cell:int,shard:int,first:bigint>>")), digits


def with_cell(keyed: DataFrame, cells: tuple[DataFrame, int]) -> DataFrame:
    """keyed(_key, ...) with _at, the cell of each row."""
    table, digits = cells
    at = F.element_at(F.filter("cells", lambda c: c["bound"] <= F.col("_key")), -1)
    return keyed.join(table, F.substring("_key", 1, digits) == F.col("start")).withColumn("_at", at).drop("start", "cells")


def splitters(keyed: DataFrame, wanted: list[tuple[int, int, float]], total: int) -> list[str]:
    """For each (numerator, denominator, slack): the first key below which at least numerator / denominator of all bytes lie.

    keyed(key, size). A slack (in bytes) allows any boundary so near. Each round is one aggregation
    over the rows of the bins still open; the driver holds those bins' parts, 16 ** STEP a boundary.
    Past the last key, the boundary is above all keys.
    """
    above = "g"
    found = [above] * len(wanted)
    open_ = {"": list(range(len(wanted)))}  # bin (leading digits) -> its boundaries
    bytes_before = {"": 0}
    digits = 0
    while open_:
        digits += STEP
        while 16**digits < 4 * len(open_.get("", ())):  # as many bins at the start as boundaries, at least
            digits += 1
        digits = min(DIGITS, digits)
        inside = keyed
        if "" not in open_:
            test = F.lit(False)
            for n in sorted({len(b) for b in open_}):
                test = test | F.substring("key", 1, n).isin([b for b in open_ if len(b) == n])
            inside = keyed.where(test)
        counted = inside.groupBy(F.substring("key", 1, digits).alias("bin")).agg(F.sum("size").alias("bytes"), F.min("key").alias("first"), F.max("key").alias("last"))
        bins = sorted((r["bin"], r["bytes"], r["first"], r["last"]) for r in counted.collect())
        names = [b[0] for b in bins]
        still: dict[str, list[int]] = {}
        for outer, boundaries in open_.items():
            mine = bins[bisect_left(names, outer) : bisect_left(names, outer + "g")]
            ends = list(accumulate((m[1] for m in mine), initial=bytes_before[outer]))  # bytes below each bin, and at the end
            for i in boundaries:
                num, den, slack = wanted[i]
                # the first bin that ends at or above the place: its first key starts below it
                k = bisect_left(ends, -(-num * total // den), 1) - 1
                if k >= len(mine):
                    continue
                name, size, first, last = mine[k]
                place, start = num * total / den, ends[k]
                if start * den >= num * total or place - start <= slack:
                    found[i] = first
                elif first == last or (start + size) * den == num * total or start + size - place <= slack:
                    found[i] = mine[k + 1][2] if k + 1 < len(mine) else f"{last}0"  # the key after the last: all of the bin is below
                else:
                    still.setdefault(name, []).append(i)
                    bytes_before[name] = start
        if still:  # go straight to where the open bins' keys differ
            spread = {b[0]: (b[2], b[3]) for b in bins}
            digits = min(next(k for k in range(DIGITS) if spread[name][0][k] != spread[name][1][k]) for name in still)
        open_ = still
    return found


def _kept(columns: list[str]) -> list[str]:
    return [c for c in columns if c.lower() not in ADDED]


def shard(docs: DataFrame, shards: int = 8, carry: list[str] | None = None) -> DataFrame:
    """docs with size, text_crc32, shard and slot (gapless from 0 in each shard), near-equal bytes a shard; sorted in each partition.

    carry: the columns of docs that go through the exchange; all of them if it isn't given.
    """
    text, spark = text_or_empty(), docs.sparkSession
    row = F.struct(*[F.col(f"`{c}`") for c in _kept(docs.columns if carry is None else carry)])  # one column: its names clash with none
    sized = docs.select(row.alias("_doc"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.col("doc_id").alias("_id"))
    sized = sized.withColumn("_key", sort_key(F.col("_id"), F.col("text_crc32"))).drop("_id")
    keyed = materialise(sized.select(F.col("_key").alias("key"), "size"), "shard-keys")
    total = keyed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    cells = min(MAX_CELLS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    wanted = [(k, shards, 0) for k in range(1, shards)]
    even = [(k, cells, total / cells * CELL_TOLERANCE) for k in range(1, cells) if k * shards % cells]
    starts = splitters(keyed, wanted + even, total) if total else []
    shard_starts = sorted(starts[: shards - 1])
    bounds = sorted(set(starts))
    shard_of = [bisect_right(shard_starts, bounds[at - 1]) if at else 0 for at in range(len(bounds) + 1)]
    # rows of each cell, and with these the first row of each cell in its shard
    counted = with_cell(keyed.withColumnRenamed("key", "_key"), cell_table(spark, bounds, [(own, 0) for own in shard_of]))
    counts = {r["cell"]: r["n"] for r in counted.groupBy(F.col("_at.cell").alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()}
    first = [0]
    for at in range(1, len(bounds) + 1):
        first.append(first[-1] + counts.get(at - 1, 0) if shard_of[at] == shard_of[at - 1] else 0)
    celled = with_cell(sized, cell_table(spark, bounds, list(zip(shard_of, first, strict=True))))
    placed = celled.repartitionById(len(bounds) + 1, F.col("_at.cell")).sortWithinPartitions("_key")
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return placed.select("_doc.*", "size", "text_crc32", F.col("_at.shard").alias("shard"), (F.col("_at.first") + local).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 8) -> None:
    """Write the sharded documents, whole, as Parquet: a folder for each shard, a file for each of its cells, rows by slot."""
    shard(docs, shards).drop("size", "text_crc32").write.partitionBy("shard").parquet(path)


def read_shards(docs: DataFrame, path: str) -> DataFrame:
    """The rows as they lie in the shards, with size and CRC-32 of what was read; docs: what was written, for its columns."""
    spark = docs.sparkSession
    kept = [docs.schema[c] for c in _kept(docs.columns)]
    schema = spark.createDataFrame([], "slot long, shard int").schema
    read = spark.read.schema(type(schema)([*kept, *schema.fields])).parquet(path)
    text = text_or_empty()
    return read.withColumns({"size": (F.octet_length(text) + 1).cast("long"), "text_crc32": F.crc32(text.cast("binary"))})


def sharded(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Shards written to the shared folder and read back."""
    path = shared_path(docs.sparkSession, "shards")
    write_shards(docs, path, shards)
    return read_shards(docs, path)
