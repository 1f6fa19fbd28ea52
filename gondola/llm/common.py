"""Pieces that several corpus operators share."""

from __future__ import annotations

import ctypes

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.sources.shared import materialise, shared_dir, shared_path, ship

__all__ = ["blocks", "connected_components", "hashed_uniform", "map_in_arrow", "materialise", "numbered", "shared_dir", "shared_path", "ship", "slices", "text_or_empty", "with_global_index", "word_count"]

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
_ROW_BITS = 33


#: Rows of an Arrow batch where the session has Spark's own number: texts are long, and each task holds a batch on either side.
BATCH_ROWS = 1024
_BATCH = ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


def give_back() -> None:
    """Hand what this worker has freed back to the system: workers wait between stages, and what they hold then is lost to the executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def map_in_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """df.mapInArrow with this package on the workers."""
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get(_BATCH[0]) == _BATCH[1]:
        spark.conf.set(_BATCH[0], BATCH_ROWS)

    def task(batches):
        yield from run(batches)
        give_back()

    return df.mapInArrow(task, schema)


def slices(batches, rows: int = 256):
    """The same rows in smaller batches, so a worker holds few of them at a time beside what it makes of them."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def blocks(batches, column: int, rows: int = 1024, size: int = 8 << 20):
    """slices of as many rows, cut where the column's texts would take more bytes than size; a longer text is alone but for empty ones."""
    for b in slices(batches, rows):
        at, held = 0, 0
        for k, n in enumerate(pc.fill_null(pc.binary_length(b.column(column)), 0).to_pylist()):
            if held and held + n > size:
                yield b.slice(at, k - at)
                at, held = k, 0
            held += n
        yield b.slice(at)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def hashed_uniform(seed: str, *columns: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the columns alone (52 bits of an MD5)."""
    key = F.concat_ws("\x1f", F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns])
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def unused(df: DataFrame, name: str) -> str:
    """A column name that df has not."""
    while name.lower() in (c.lower() for c in df.columns):
        name = f"_{name}"
    return name


def numbered(df: DataFrame, name: str, label: str, compression: str = "snappy") -> DataFrame:
    """df written to the shared folder, with the gapless index 0..n-1 of its rows as they lie in its partitions.

    The partitions' offsets (as many rows as the write had tasks, of 12 bytes) are broadcast. A
    column of df named like the index is replaced.
    """
    at, number, before = (unused(df, c) for c in ("_at", "_part", "_before"))
    placed = materialise(df.withColumn(at, F.monotonically_increasing_id()), label, compression)
    part = F.shiftrightunsigned(at, _ROW_BITS).cast("int")
    counts = sorted((r["part"], r["n"]) for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, rows = [], 0
    for p, n in counts:
        offsets.append((p, rows))
        rows += n
    starts = F.broadcast(df.sparkSession.createDataFrame(offsets, f"{number} int, {before} long"))
    index = F.col(before) + F.col(at).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.withColumn(number, part).join(starts, number).withColumn(name, index).drop(number, before, at)


def with_global_index(df: DataFrame, order: list[Column], name: str, label: str = "index") -> DataFrame:
    """Add the gapless index 0..n-1 of each row in the given total order: one range exchange, no single-task sort."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return numbered(df.repartitionByRange(parts, *order).sortWithinPartitions(*order), name, label)


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """node, component (the smallest node reachable) for every node of edges(a long, b long).

    Labels spread along the edges and jump to their own label's label until their sum stands
    still; each round is two joins and is written to the shared folder.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = materialise(both.where("a <> b").distinct(), f"{label}-links")
    labels = materialise(
        links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("component")),
        f"{label}-labels",
    )
    total = labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
    while total is not None:
        spread = links.join(labels.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "component")
        spread = spread.union(labels).groupBy("node").agg(F.min("component").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("_up"))
        jumped = spread.join(jump, "component", "left").select("node", F.least("component", F.coalesce("_up", "component")).alias("component"))
        labels = materialise(jumped, f"{label}-labels")
        now = labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
        if now == total:
            break
        total = now
    return labels
