"""Embedding near-dedup: an exact metric range join.

Vectors are scaled to length one, where cosine >= c is distance <= e = sqrt(2 - 2c). Pivots (a
bounded, hash-ordered sample, far from one another) split them into cells by the nearest pivot. By the triangle
inequality a vector x can only have partners in a cell of pivot p if d(x, p) is at most the cell's
radius + e and at most d(x, own pivot) + 2e, and if x's distance to each pivot of a table lies
within e of those that the cell's members have to it. It is replicated to such cells alone. Large
cells are cut into blocks by a hash, and every pair of blocks that may hold a link is compared by
one task with matrix products: it returns each vector's number of links and a spanning forest,
never the pairs themselves.

Pivots only steer the work; every vector is compared whatever the sample. Defined cases: vectors
that are null, empty, zero or hold null or non-finite components link with nothing; vectors of
different lengths don't link; equal vectors and repeated rows link like any others; a null id
takes part but never names a component; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import connected_components, map_in_arrow, materialise, slices

COSINE = 0.95
#: Bytes of a block at most: two of them, a few copies and a strip of their products fit a task.
BLOCK_BYTES = 32 << 20
#: Pairs of blocks for each core while blocks are smaller than that.
PAIRS_PER_CORE = 3
#: At most so many pivots, all of a bounded sample, and how many of them the table has (two numbers for each and each cell).
MAX_PIVOTS, TABLE_PIVOTS = 1024, 64
#: So many products are held at once.
_STRIP_CELLS = 1 << 22


def unit_rows(values: list) -> tuple[np.ndarray, np.ndarray]:
    """The rows (all of one length) in double precision, scaled to length one; and which rows are usable."""
    x = np.array(values, np.float64).reshape(len(values), -1)
    with np.errstate(all="ignore"):
        scale = np.abs(x).max(axis=1, initial=0, keepdims=True)
        x = x / np.where(scale > 0, scale, 1)
        norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
        fine = np.isfinite(x).all(axis=1) & np.isfinite(scale[:, 0]) & (norm[:, 0] > 0)
        return x / np.where(norm > 0, norm, 1), fine


def _usable(df: DataFrame) -> DataFrame:
    """_row, vec_id, dim, v (as doubles) of the vectors that can link."""
    v = F.col("embedding").cast("array<double>")
    whole = df.select(F.monotonically_increasing_id().alias("_row"), F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    usable = F.coalesce((F.size("v") > 0) & ~bad & F.exists("v", lambda x: x != 0), F.lit(False))
    return materialise(whole.select("_row", "vec_id", F.when(usable, F.size("v")).alias("dim"), F.when(usable, F.col("v")).alias("v")), "vectors")


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * (x @ pivots.T)))


def spread(x: np.ndarray, n: int) -> np.ndarray:
    """n rows of x at most, each the farthest from those before it; equal rows are taken once."""
    chosen, far = [0], _distances(x, x[:1])[:, 0]
    while len(chosen) < n and far.max() > 1e-6:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, _distances(x, x[chosen[-1:]])[:, 0])
    return x[chosen]


def _join(parent: np.ndarray, row: int, cols: np.ndarray) -> None:
    """Put a row and all columns that it hits under one root, in arrays: never one by one."""
    at = np.append(cols, row)
    top = parent[at]
    while True:
        above = parent[top]
        if np.array_equal(above, top):
            break
        top = above
    low = top.min()
    parent[top] = low
    parent[at] = low


def compare(left: tuple, right: tuple | None, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of two blocks (ids, unit vectors), or within one: the ids that link, their links, and the smallest id of each one's tree."""
    ids, x = left
    other_ids, y = right or left
    every = ids if right is None else np.concatenate([ids, other_ids])
    shift = 0 if right is None else len(ids)
    n, parent = np.zeros(len(every), np.int64), np.arange(len(every))
    strip = max(1, _STRIP_CELLS // max(1, len(other_ids)))
    for at in range(0, len(ids), strip):
        hits = x[at : at + strip] @ y.T >= cosine
        if right is None:
            hits[np.arange(len(hits)), at + np.arange(len(hits))] = False
        else:
            n[shift:] += hits.sum(axis=0)
        own = hits.sum(axis=1)
        n[at : at + len(hits)] += own
        for r in np.flatnonzero(own):
            _join(parent, at + r, shift + np.flatnonzero(hits[r]))
    while not np.array_equal(parent, parent[parent]):
        parent = parent[parent]
    lowest = np.full(len(every), np.iinfo(np.int64).max)
    np.minimum.at(lowest, parent, every)
    found = n > 0
    return every[found], n[found], lowest[parent[found]]


def _block_rows(dim: int, n: int, cores: int) -> int:
    """Rows of a block: a few pairs of blocks for each core, up to what a task can hold."""
    blocks = math.ceil(math.sqrt(2 * PAIRS_PER_CORE * cores))
    return max(1, min(-(-n // blocks), BLOCK_BYTES // (8 * dim)))


def block_pairs(df: DataFrame, cosine: float = COSINE, block_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, pairs): rows(_row, vec_id, ...) of df(vec_id, embedding), and pairs(dim, c1, b1, c2, b2, side, _row, v), the members of each pair of blocks."""
    reach = math.sqrt(2 - 2 * cosine) + 1e-9
    rows = _usable(df)
    whole = rows.where("dim is not null")
    # a row for each length of vectors, with a pivot for sure
    lengths = whole.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.min_by("v", F.xxhash64("_row")).alias("v")).collect()
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = {r["dim"]: block_rows or _block_rows(r["dim"], r["n"], cores) for r in lengths}
    wanted = {r["dim"]: min(MAX_PIVOTS, -(-r["n"] // size[r["dim"]])) for r in lengths}
    sample = {r["dim"]: [list(r["v"])] for r in lengths}
    several = [(r["dim"], 4.0 * wanted[r["dim"]] / r["n"]) for r in lengths if wanted[r["dim"]] > 1]
    if several:  # about four times as many rows as wanted, by a hash of their number
        share = df.sparkSession.createDataFrame(several, "dim int, share double")
        drawn = whole.join(F.broadcast(share), "dim").where((F.pmod(F.xxhash64("_row"), F.lit(1 << 30)) / float(1 << 30)) < F.col("share"))
        for r in drawn.select("dim", "v").collect():
            sample[r["dim"]].append(list(r["v"]))
    pivots = {dim: spread(unit_rows(vs)[0], wanted[dim]) for dim, vs in sample.items()}

    def celled(batches):
        for b in batches:
            dims, vs = b.column(1).to_pylist(), b.column(2).to_pylist()
            cell, far = np.zeros(len(dims), np.int32), np.zeros(len(dims))
            for dim in set(dims):
                at = [i for i, d in enumerate(dims) if d == dim]
                d = _distances(unit_rows([vs[i] for i in at])[0], pivots[dim])
                cell[at], far[at] = d.argmin(axis=1), d.min(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(far)], ["_row", "dim", "v", "cell", "far"])

    fields = "_row long, dim int, v array<double>, cell int, far double"
    placed = materialise(map_in_arrow(whole.select("_row", "dim", "v"), celled, fields), "vectors-celled")
    def ranges(batches):
        for b in batches:
            dims, own = np.array(b.column(1).to_pylist()), b.column(3).to_numpy()
            out = []
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                d = _distances(unit_rows(b.column(2).take(pa.array(at)).to_pylist())[0], pivots[dim][:TABLE_PIVOTS])
                for c in np.unique(own[at]).tolist():
                    mine = d[own[at] == c]
                    out.append((dim, c, len(mine), mine.min(axis=0).tolist(), mine.max(axis=0).tolist()))
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["dim", "cell", "n", "low", "high"])

    # as many rows as there are pivots, each with the table's ranges of distances
    parts = map_in_arrow(placed, ranges, "dim int, cell int, n long, low array<double>, high array<double>")
    each = parts.select("dim", "cell", "n", F.posexplode(F.arrays_zip("low", "high")).alias("k", "x"))
    each = each.groupBy("dim", "cell", "k").agg(F.sum("n").alias("n"), F.min("x.low").alias("low"), F.max("x.high").alias("high"))
    table = each.groupBy("dim", "cell").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("k", "low", "high"))).alias("ranges"))
    radius = placed.groupBy("dim", "cell").agg(F.max("far").alias("far"))
    held = {(r["dim"], r["cell"]): r for r in table.join(radius, ["dim", "cell"]).collect()}
    here = {dim: [c for c in range(len(pivots[dim])) if (dim, c) in held] for dim in pivots}
    far = {dim: np.array([held[dim, c]["far"] for c in cs]) for dim, cs in here.items()}
    low, high = ({dim: np.array([[x[side] for x in held[dim, c]["ranges"]] for c in cs]) for dim, cs in here.items()} for side in ("low", "high"))
    blocks = {c: -(-r["n"] // size[c[0]]) for c, r in held.items()}

    def reached(dim: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and cell (its place in here) of every vector and cell that may hold a partner of it."""
        d = _distances(x, pivots[dim][here[dim]])
        i, c = np.nonzero((d <= far[dim] + reach) & (d <= d.min(axis=1, keepdims=True) + 2 * reach))
        to = _distances(x, pivots[dim][:TABLE_PIVOTS])
        for k in range(to.shape[1]):
            keep = (to[i, k] >= low[dim][c, k] - reach) & (to[i, k] <= high[dim][c, k] + reach)
            i, c = i[keep], c[keep]
        return i, c

    def replicated(batches):
        for b in slices(batches, 2048):
            rows_, dims, own_cells = (b.column(k).to_pylist() for k in (0, 1, 3))
            vs = b.column(2).to_pylist()
            out = {k: [] for k in ("dim", "c1", "b1", "c2", "b2", "side", "at")}
            for d in set(dims):
                mine = [i for i, x in enumerate(dims) if x == d]
                for i, c in zip(*(x.tolist() for x in reached(d, unit_rows([vs[i] for i in mine])[0]))):
                    i = mine[i]
                    own = (own_cells[i], (rows_[i] * 2654435761 >> 15) % blocks[d, own_cells[i]])
                    for k in range(blocks[d, here[d][c]]):
                        first, second = sorted((own, (here[d][c], k)))
                        for key, value in zip(out, (d, *first, *second, int(own == second and first != second), i)):
                            out[key].append(value)
            at = np.array(out.pop("at"), np.int64)
            arrays = [pa.array(x, pa.int32()) for x in out.values()]
            yield pa.RecordBatch.from_arrays([*arrays, b.column(0).take(pa.array(at)), b.column(2).take(pa.array(at))], [*out, "_row", "v"])

    return rows, map_in_arrow(placed, replicated, "dim int, c1 int, b1 int, c2 int, b2 int, side int, _row long, v array<double>")


def range_links(df: DataFrame, cosine: float = COSINE, block_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, found): rows(_row, vec_id, ...) of df(vec_id, embedding), and found(_row, n_links, root) of the blocks compared."""
    rows, pairs = block_pairs(df, cosine, block_rows)

    def linked(table: pa.Table) -> pa.Table:
        side, ids = table.column("side").to_numpy(), table.column("_row").to_numpy()
        dim = table.column("dim")[0].as_py()
        flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        x, _ = unit_rows(flat)
        order = np.argsort(ids, kind="stable")
        side, ids, x = side[order], ids[order], x[order]
        same = table.column("c1")[0] == table.column("c2")[0] and table.column("b1")[0] == table.column("b2")[0]
        a, b = (ids[side == 0], x[side == 0]), (ids[side == 1], x[side == 1])
        return pa.table([pa.array(c) for c in compare(a, None if same else b, cosine)], ["_row", "n_links", "root"])

    found = pairs.groupBy("dim", "c1", "b1", "c2", "b2").applyInArrow(linked, "_row long, n_links long, root long")
    return rows, materialise(found, "vectors-links")


def near_groups(df: DataFrame, cosine: float = COSINE, block_rows: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of df(vec_id, embedding)."""
    rows, found = range_links(df, cosine, block_rows)
    counts = found.groupBy("_row").agg(F.sum("n_links").alias("n_links"))
    nodes = connected_components(found.where("_row <> root").select(F.col("_row").alias("a"), F.col("root").alias("b")), "vectors")
    own = rows.select("_row", "vec_id").join(counts, "_row", "left").join(nodes.withColumnRenamed("node", "_row"), "_row", "left")
    own = own.withColumn("component", F.coalesce("component", "_row"))
    first = own.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return own.join(first, "component").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
