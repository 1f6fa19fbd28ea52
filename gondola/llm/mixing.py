"""Mixing sources to target weights.

Words are summed per source; every source's target is its share of all words by weight, stopped
at ``max_epochs`` times the source's own size, the excess reshared by weight until no source is
above its stop. A document of a source with repetition rate r = target / size is emitted
floor(r) times, plus one copy whose hash-seeded draw falls below r - floor(r).

Defined cases: a null text has size 0 and is an ordinary (wordless) document; a null source is a
source of its own and comes last; repeated rows draw alike; a source without words has target 0
and emits nothing; an empty table gives an empty result. The plan replaces input columns named like
one it adds (``size``, ``source_size``, ``target``, ``copies``); the mix returns all columns as they came.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import hashed_uniform, materialise, text_or_empty, with_global_index, word_count

SEED = "mix-1"
MAX_EPOCHS = 3
#: A source table up to this many rows is broadcast (well under 100 MB); a larger one is joined by shuffle.
BROADCAST_SOURCES = 500_000
#: What the plan adds to a row.
ADDED = ("size", "source_size", "target", "copies")


def cyclic_weight(rank: Column) -> Column:
    """1, 2, 3, 1, 2, 3, ... by rank from 0."""
    return rank % 3 + 1


def source_targets(sizes: DataFrame, weight=cyclic_weight, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target for every source of sizes(source, size)."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_global_index(sources, [F.col("source").asc_nulls_last()], "rank", "mix-rank")
    ranked = materialise(
        ranked.select("source", "source_size", weight(F.col("rank")).cast("long").alias("weight"), (F.col("source_size") * max_epochs).alias("stop")),
        "mix-sources",
    )
    total = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, stopped = 0.0, -1
    while True:  # the level only rises, so each round stops more sources or ends
        above = F.col("weight") * F.lit(level) > F.col("stop")
        full, rest, n = ranked.agg(
            F.coalesce(F.sum(F.when(above, F.col("stop"))), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)), F.count_if(above)
        ).first()
        if n == stopped or not rest:
            break
        level, stopped = (total - full) / rest, n
    target = F.least(F.col("weight") * F.lit(level), F.col("stop").cast("double"))
    return ranked.select("source", "source_size", target.alias("target"))


def mixing_plan(docs: DataFrame, weight=cyclic_weight, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """docs with size, source_size, target (both of the source) and copies, the times the mix emits the row; columns of these names are replaced."""
    kept = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ADDED])  # one column: its names clash with none
    sized = docs.select(kept.alias("_doc"), F.col("doc_id").alias("_id"), "source", word_count(text_or_empty()).alias("size"))
    targets = materialise(source_targets(sized.select("source", "size"), weight, max_epochs), "mix-targets")
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    extra = (hashed_uniform(seed, F.col("_id")) < rate - F.floor(rate)).cast("long")
    joined = sized.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left")
    return joined.select("_doc.*", "size", "source_size", "target", (F.floor(rate) + extra).alias("copies"))


def mix(docs: DataFrame, weight=cyclic_weight, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself: each row of docs, with its own columns, as many times as the plan says."""
    whole = docs.select("doc_id", "text", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    planned = mixing_plan(whole, weight, max_epochs, seed).where("copies > 0")
    return planned.select("_doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("_doc.*")
