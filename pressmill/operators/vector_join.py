"""Similarity of vectors between two row sets, exact, without pairs of rows leaving a task.

Rows get a cell: that of the nearest of a few reference vectors. By the triangle inequality of
angles a vector can only have partners within angle t in cells whose reference is not farther away
than its own by more than 2t, so it is compared with those only. Neighbouring small cells are packed together, and both sides
of a pack are split into stripes of bounded size by hash: a vector is sent once per stripe, not once per cell or block. A task
goes through a pair of stripes cell by cell and block by block (numpy) and returns one row per
probe row at most. A cell that holds a third of all rows is many pairs of stripes, never one task.
"""
from __future__ import annotations

import math
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import norm
from ..session import materialize
from .greedy import keep_first

BLOCK = 2048
#: rows of either side that meet in a task
STRIPE = 16_384
CELL_ROWS = 200_000
MAX_CELLS = 256


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.asarray(vectors.tolist(), dtype=np.float64)


def unit_rows(rows: DataFrame, vector: str, arrival: str) -> DataFrame:
    """(arrival, dim, unit) of the rows that can be similar to another.

    Vectors that are empty, have a null or NaN, or a norm that is 0 (underflow counts) or infinite are similar
    to nothing and are left out here; those who drop rows keep them."""
    def scale(batches):
        for pdf in batches:
            if len(pdf):
                arrays = [np.asarray(v, dtype=np.float64) for v in pdf[vector]]
                yield pd.DataFrame({
                    "arrival": pdf[arrival].to_numpy(), "dim": np.array([len(a) for a in arrays], dtype=np.int32),
                    "unit": [a / math.sqrt(float(a @ a)) for a in arrays]})

    wanted = rows.select(F.col(arrival).cast("long").alias(arrival), F.col(vector).cast("array<double>").alias(vector)).filter(
        (F.size(vector) > 0) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x)))
    length = norm(F.col(vector))
    wanted = wanted.filter((length > 0) & (length < float("inf")))
    return wanted.mapInPandas(scale, "arrival long, dim int, unit array<double>")


def references(rows: DataFrame, cells: int) -> np.ndarray:
    """A fixed number of rows (at most MAX_CELLS) used as reference vectors."""
    head = rows.orderBy(F.xxhash64("arrival"), "arrival").limit(cells).select("unit").toPandas()
    return _matrix(head["unit"]) if len(head) else np.zeros((0, 0))


def _angles(units: np.ndarray, refs: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ refs.T, -1.0, 1.0))


def _reached(units: np.ndarray, refs: np.ndarray, reach: float) -> np.ndarray:
    """Which cells can hold a partner, row by row."""
    angles = _angles(units, refs)
    return angles <= angles.min(axis=1, keepdims=True) + reach + 1e-9


def _cells(batches, refs: np.ndarray):
    """Cell of each row."""
    for pdf in batches:
        if len(pdf):
            yield pdf.assign(cell=_angles(_matrix(pdf["unit"]), refs).argmin(axis=1).astype(np.int32))


def _packs(batches, refs: np.ndarray, reach: float, packs: np.ndarray):
    """Packs that have a cell which can hold a partner."""
    starts = np.flatnonzero(np.diff(packs, prepend=-1))
    for pdf in batches:
        if len(pdf):
            hit = np.logical_or.reduceat(_reached(_matrix(pdf["unit"]), refs, reach), starts, axis=1)
            yield pdf.assign(packs=[np.flatnonzero(row).astype(np.int32) for row in hit])


def _packed(counts: dict[int, int], cells: int, stripe: int) -> np.ndarray:
    """Pack of each cell: cells in a row that begin within one stripe of rows."""
    sizes = np.array([counts.get(c, 0) for c in range(cells)])
    begins = (np.cumsum(sizes) - sizes) // stripe
    return np.unique(begins, return_inverse=True)[1]


def _block_pair(
    probe: pd.DataFrame, index: pd.DataFrame, threshold: float, earlier: bool, refs: np.ndarray | None, reach: float, block: int,
) -> pd.DataFrame:
    """Earliest similar index row for each probe row of one pair of stripes."""
    none = np.iinfo(np.int64).max
    empty = pd.DataFrame({"arrival": pd.Series(dtype="int64"), "first": pd.Series(dtype="int64")})
    if not len(probe) or not len(index):
        return empty
    index = index.sort_values(["icell", "iarrival"])
    at, cells = index["iarrival"].to_numpy(), index["icell"].to_numpy()
    asked = probe["arrival"].to_numpy()
    left, right = _matrix(probe["unit"]), _matrix(index["iunit"])
    best = np.full(len(asked), none)
    bounds = [*np.flatnonzero(np.diff(cells, prepend=cells[0] - 1)).tolist(), len(cells)]
    for start in range(0, len(asked), BLOCK):
        rows = np.arange(start, min(start + BLOCK, len(asked)))
        reached = None if refs is None else _reached(left[rows], refs, reach)
        for low, high in zip(bounds, bounds[1:]):
            some = rows if reached is None else rows[reached[:, cells[low]]]
            units = left[some]
            for begin in range(low, high if len(some) else low, block):
                part = slice(begin, min(begin + block, high))
                similar = units @ right[part].T >= threshold
                if earlier:
                    similar &= at[None, part] < asked[some, None]
                hit = similar.any(axis=1)
                best[some[hit]] = np.minimum(best[some[hit]], at[part][similar[hit].argmax(axis=1)])
    found = best < none
    return pd.DataFrame({"arrival": asked[found], "first": best[found]})


def _settle_block(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Greedy selection within one block of at most BLOCK rows."""
    rows = rows.sort_values("arrival")
    units = _matrix(rows["unit"])
    similar = units @ units.T >= threshold
    kept = np.zeros(len(rows), dtype=bool)
    for i in range(len(rows)):
        kept[i] = not (similar[i] & kept).any()
    return rows[kept]


def settle_vectors(rows: DataFrame, threshold: float) -> DataFrame:
    return rows.groupBy("dim").applyInPandas(
        lambda pdf: _settle_block(pdf, threshold), "arrival long, dim int, unit array<double>")


def nearest_vectors(
    probe: DataFrame, index: DataFrame, earlier: bool, threshold: float,
    refs: np.ndarray | None = None, block: int = BLOCK, stripe: int = STRIPE,
) -> DataFrame:
    """(arrival, first): per probe row the earliest index row with cosine >= threshold.

    Both inputs are (arrival, dim, unit). Vectors of unequal length are never similar.
    """
    reach = 2 * math.acos(max(-1.0, min(1.0, threshold)))
    if refs is None or len(refs) < 2:
        refs = None
        left, right = probe.withColumn("cell", F.lit(0)), index.withColumns({"cell": F.lit(0), "pack": F.lit(0)})
    else:
        schema = "arrival long, dim int, unit array<double>"
        celled = index.mapInPandas(partial(_cells, refs=refs), f"{schema}, cell int")
        packs = _packed({r["cell"]: r["count"] for r in celled.groupBy("cell").count().collect()}, len(refs), stripe)  # MAX_CELLS rows
        right = celled.withColumn("pack", F.element_at(F.lit(packs.tolist()), F.col("cell") + 1).cast("int"))
        left = probe.mapInPandas(partial(_packs, refs=refs, reach=reach, packs=packs), f"{schema}, packs array<int>").withColumn(
            "cell", F.explode("packs")).drop("packs")
    right = right.withColumnsRenamed({"cell": "own_cell", "pack": "cell"})  # from here on a cell is a pack of them
    stripe = max(stripe, block)

    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / stripe).cast("int").alias(name))

    grid = blocks(left, "lb").join(blocks(right, "rb"), ["dim", "cell"])
    # one row per cell that is present on both sides: at most MAX_CELLS per vector length
    grid = F.broadcast(grid)

    def own(n: str):
        return F.pmod(F.xxhash64("arrival"), F.col(n)).cast("int")

    left = left.join(grid, ["dim", "cell"]).select(
        "dim", "cell", own("lb").alias("l"), F.explode(F.sequence(F.lit(0), F.col("rb") - 1)).alias("r"),
        "arrival", "unit")
    right = right.join(grid, ["dim", "cell"]).select(
        F.col("dim").alias("idim"), F.col("cell").alias("icell"),
        F.explode(F.sequence(F.lit(0), F.col("lb") - 1)).alias("il"), own("rb").alias("ir"),
        F.col("arrival").alias("iarrival"), F.col("unit").alias("iunit"),
        F.col("own_cell").alias("own_icell"))
    found = left.groupBy("dim", "cell", "l", "r").cogroup(right.groupBy("idim", "icell", "il", "ir")).applyInPandas(
        lambda p, i: _block_pair(p, i.drop(columns="icell").rename(columns={"own_icell": "icell"}), threshold, earlier, refs, reach, block),
        "arrival long, first long")
    return found.groupBy("arrival").agg(F.min("first").alias("first"))


def prepared(rows: DataFrame, vector: str, arrival: str, cell_rows: int) -> tuple[DataFrame, np.ndarray | None]:
    """Unit vectors, written once, and the reference vectors for their number."""
    units = materialize(unit_rows(rows, vector, arrival), "units")
    lengths = units.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("dim").alias("dims")).first()
    cells = min(MAX_CELLS, math.ceil(lengths["n"] / cell_rows))
    refs = references(units, cells) if cells > 1 and lengths["dims"] == 1 else None
    return units, refs


def keep_first_vectors(
    rows: DataFrame, threshold: float, vector: str = "embedding", arrival: str = "arrival",
    cell_rows: int = CELL_ROWS, block: int = BLOCK, **batches,
) -> DataFrame:
    """Rows kept when near-equal vectors of earlier kept rows drop the later ones."""
    units, refs = prepared(rows, vector, arrival, cell_rows)
    # equal vectors: all but the first are dropped whatever happens to the first
    single = units.groupBy("unit", "dim").agg(F.min("arrival").alias("arrival")).select("arrival", "dim", "unit")
    kept = keep_first(
        single, lambda p, i, e: nearest_vectors(p, i, e, threshold, refs, block), "arrival",
        settle=lambda left: settle_vectors(left, threshold), settle_rows=block, **batches)
    # whatever was never compared is not dropped
    dropped = units.select("arrival").join(kept.select("arrival"), "arrival", "left_anti")
    return rows.join(dropped.withColumnRenamed("arrival", arrival), arrival, "left_anti")


def not_near(
    rows: DataFrame, stored: DataFrame, threshold: float, vector: str = "embedding", arrival: str = "arrival",
    cell_rows: int = CELL_ROWS, block: int = BLOCK,
) -> DataFrame:
    """Rows without a similar vector among the stored ones (anti join on similarity)."""
    numbered = stored.select(F.xxhash64(vector).alias("arrival"), F.col(vector)).dropDuplicates([vector])
    index, refs = prepared(numbered, vector, "arrival", cell_rows)
    hit = nearest_vectors(unit_rows(rows, vector, arrival), index, False, threshold, refs, block)
    return rows.join(hit.select(F.col("arrival").alias(arrival)), arrival, "left_anti")


def assign_first(
    rows: DataFrame, leaders: DataFrame, threshold: float, vector: str = "embedding", arrival: str = "arrival",
    cell_rows: int = CELL_ROWS, block: int = BLOCK,
) -> DataFrame:
    """(arrival, leader): the earliest similar leader of each row; a leader leads itself."""
    units, refs = prepared(rows, vector, arrival, cell_rows)
    heads = units.join(leaders.select(F.col(arrival).alias("arrival")), "arrival", "left_semi")
    others = units.join(leaders.select(F.col(arrival).alias("arrival")), "arrival", "left_anti")
    near = nearest_vectors(others, heads, True, threshold, refs, block).withColumnRenamed("first", "leader")
    own = heads.select("arrival", F.col("arrival").alias("leader"))
    return own.unionByName(near)
