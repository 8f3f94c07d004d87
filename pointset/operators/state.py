"""Points with their nearest centre, for centre sets that only grow."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.durable import Cache, discard, is_kept, materialize
from . import kernels

# Cells (centres x dimensions) compared anew in each pass before the result is
# kept as a generation.  Below this, comparing again costs less per point than
# storing and reading the point once more.
FOLD_CELLS = 16_384
# Distances between centres that may be shipped to the tasks; beyond, all are compared.
GAP_CELLS = 4_000_000
# Generations chained before one is written out and the lineage cut.
CHECKPOINT_EVERY = 4


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances, row by row of ``b``: a table of old and new centres."""
    return np.stack([np.sum((a - row) ** 2, axis=1) for row in b], axis=1)


def in_blocks(pts: DataFrame) -> bool:
    return isinstance(pts.schema["x"].dataType, T.BinaryType)


def keep_points(pts: DataFrame, policy: Cache, again: bool = False) -> DataFrame:
    """The vectors for many passes: kept in blocks, unless they are kept already or nothing is.

    A block holds the bytes of many points: half the memory of a row each, and none of
    them is converted again on its way to a kernel.  ``again`` also makes blocks of what
    is kept.
    """
    vectors = pts.select("x")
    if not policy.keeps or is_kept(pts) and not again:
        return vectors
    return policy.hold(vectors.mapInArrow(kernels.packed(), kernels.BLOCKS))


class NearestState:
    """Keeps ``cid`` (order of arrival) and ``d2`` up to date as centres are added.

    A pass compares the points of the latest generation with the centres that
    came after it, but for those too far from a point's centre to be nearer to the
    point.  The first generation is the base table itself.  Without caching it stays
    the only one and nothing is chained.  ``measured`` counts the distances.
    """

    def __init__(self, pts: DataFrame, cache: Cache, fold_cells: int | None = None, checkpoint_every: int | None = None):
        self.base = pts
        self.cache = cache
        self.fold_cells = FOLD_CELLS if fold_cells is None else fold_cells
        self.checkpoint_every = CHECKPOINT_EVERY if checkpoint_every is None else checkpoint_every
        self.centres: np.ndarray | None = None
        self.rank: np.ndarray | None = None
        self.df: DataFrame | None = None
        self._generation: DataFrame | None = None
        self._folded = 0
        self._chained = 0
        self._held: list[DataFrame] = []
        self._written: list[DataFrame] = []

    def add(self, new: np.ndarray) -> DataFrame:
        known = 0 if self.centres is None else len(self.centres)
        if self.cache.keeps and (known - self._folded) * new.shape[1] > self.fold_cells:
            self._fold(known)
        self.centres = new if self.centres is None else np.vstack([self.centres, new])
        # Place of each centre among the distinct ones in vector order: settles
        # ties, so that ids can be replaced by these places in the end.
        self.rank = np.unique(self.centres, axis=0, return_inverse=True)[1].reshape(-1)
        self.df = self._matched()
        return self.df

    def _latest(self) -> tuple[DataFrame, np.ndarray, np.ndarray, np.ndarray | None]:
        """The latest generation, the centres that came after it and their gaps to the others."""
        ids = np.arange(self._folded, len(self.centres))
        ids = ids[np.argsort(self.rank[ids], kind="stable")]
        block = self.centres[ids]
        if self._generation is None:
            return self.base, ids, block, None
        few = self._folded * len(block) <= GAP_CELLS
        return self._generation, ids, block, squared_distances(self.centres[: self._folded], block) if few else None

    def _matched(self) -> DataFrame:
        source, ids, block, gaps = self._latest()
        x = F.col("x")
        if self._generation is None:
            found = kernels.first_counted_column(x, ids, block)
        else:
            found = kernels.lower_counted_column(x, F.col("cid"), F.col("d2"), ids, block, self.rank, gaps)
        columns = self.base.columns
        matched = source.select(*columns, found.alias("_m"))
        return matched.select(
            *columns, F.col("_m.cid").alias("cid"), F.col("_m.d2").alias("d2"), F.col("_m.n").alias("measured")
        )

    def _fold(self, known: int) -> None:
        """Make the current state the generation that later passes start from."""
        self._chained += 1
        if self._chained % self.checkpoint_every == 0:
            self._generation = materialize(self.df.drop("measured"), "state")
            self._written.append(self._generation)
        else:
            self._generation = self.cache.hold(self.df.drop("measured"))
            self._held.append(self._generation)
        self._folded = known

    def settled(self) -> None:
        """To be called once the current state has been computed."""
        if self.cache.mode == "unpersist":
            self._forget(self._generation)

    def close(self) -> None:
        if self.cache.mode == "unpersist":
            self._forget(None)

    def _forget(self, latest: DataFrame | None) -> None:
        for df in [d for d in self._held if d is not latest]:
            df.unpersist()
            self._held.remove(df)
        for df in [d for d in self._written if d is not latest]:
            discard(df)
            self._written.remove(df)


class BlockState(NearestState):
    """The same for vectors without ids, in rows or in blocks, of which sums are asked only."""

    def _matched(self) -> DataFrame:
        source, ids, block, gaps = self._latest()
        return source.mapInArrow(kernels.matched_blocks(ids, block, self.rank, gaps), kernels.MATCHED_BLOCKS)

    def _sums(self, sizes: bool) -> DataFrame:
        source, ids, block, gaps = self._latest()
        run = kernels.matched_sums(ids, block, self.rank, gaps, sizes)
        return source.mapInArrow(run, kernels.MATCHED_SUMS)

    def totals(self):
        """``psi, n, measured`` of all points: cost, rows and distances measured; null without rows."""
        asked = [F.sum("d2").alias("psi"), F.sum("n").alias("n"), F.sum("measured").alias("measured")]
        return self._sums(False).agg(*asked).head()

    def sizes(self) -> dict[int, int]:
        """Points of every centre that has some."""
        return {row.cid: row.n for row in self._sums(True).groupBy("cid").agg(F.sum("n").alias("n")).collect()}
