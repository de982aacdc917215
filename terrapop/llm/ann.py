"""Operator 6: nearest neighbours by collision counting over sorted projections.

Vectors are dealt into bounded blocks, each indexed once: every random projection keeps
its values in sorted order. Only queries are copied, one to each block, and stream past its
index a batch at a time. A window centred at the query widens with the radius (virtual
rehashing); a vector whose rank falls into enough of the windows is verified by its true
inner product. Windows hold some two fifths of all vectors of a block, so collisions are
counted by comparing ranks in order of memory, not by walking the windows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import runs


@dataclass(frozen=True)
class AnnConfig:
    """At radius R a window reaches ``reach`` R to either side, and ``share`` of the
    ``projections`` must collide before a vector is verified: a vector at distance R does
    so in 55 % of them. Radii start below the nearest of ``probe`` vectors and grow by
    ``growth``."""

    k: int = 20
    projections: int = 128
    reach: float = 0.75
    share: float = 0.505
    probe: int = 512
    start: float = 0.92
    growth: float = 1.1
    block_vectors: int = 20_000
    block_queries: int = 512
    seed: int = 11


class CollisionIndex:
    """Sorted projections of one block of vectors, and each vector's rank in them.

    Largest inner product becomes least distance by one more coordinate: vectors are
    scaled by the largest norm and filled up to length 1, queries have length 1 and 0
    there.
    """

    def __init__(self, vectors: np.ndarray, cfg: AnnConfig):
        if len(vectors) > 65_535:
            raise ValueError("ranks have 16 bits")
        self.vectors, self.cfg = vectors, cfg
        norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        self.scale = norms.max()
        unit = np.column_stack([vectors / self.scale, np.sqrt(np.maximum(0.0, 1 - (norms / self.scale) ** 2))])
        self.axes = np.random.default_rng(cfg.seed).standard_normal((unit.shape[1], cfg.projections))
        values = (unit @ self.axes).T
        self.sorted = np.sort(values, axis=1)
        self.rank = np.empty(values.shape, np.uint16)
        np.put_along_axis(self.rank, np.argsort(values, axis=1), np.arange(len(vectors), dtype=np.uint16)[None], axis=1)

    def collisions(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """For each vector, the windows [lo, hi) of the sorted arrays that hold it."""
        counts = np.zeros(len(self.vectors), np.uint8)
        for rank, a, b in zip(self.rank, lo.astype(np.uint16), hi.astype(np.uint16), strict=True):
            counts += (rank - a < b - a).view(np.uint8)
        return counts

    def search(self, queries: np.ndarray) -> Iterator[np.ndarray]:
        """For each query, the rows that were verified; none is left out for number.

        The window widens until more than ``k`` verified vectors lie within the radius,
        or all vectors are verified.
        """
        cfg = self.cfg
        lengths = np.sqrt(np.einsum("ij,ij->i", queries, queries))
        centres = (queries / lengths[:, None]) @ self.axes[:-1]
        need = int(np.ceil(cfg.share * cfg.projections))
        step = max(1, len(self.vectors) // cfg.probe)
        m = len(queries)
        away = lambda i, rows: 2 - 2 * (self.vectors[rows] @ queries[i]) / (self.scale * lengths[i])  # noqa: E731  squared distances
        radius = np.zeros(m)
        for i in range(m):
            squares = away(i, slice(0, None, step))
            radius[i] = cfg.start * np.sqrt(squares[squares > 1e-5].min(initial=4.0))
        seen, near = np.zeros((m, len(self.vectors)), bool), [np.zeros(0)] * m
        going = np.arange(m)
        while len(going):
            reach = cfg.reach * radius[going]
            lo = np.stack([np.searchsorted(s, c - reach, "left") for s, c in zip(self.sorted, centres[going].T, strict=True)], axis=1)
            hi = np.stack([np.searchsorted(s, c + reach, "right") for s, c in zip(self.sorted, centres[going].T, strict=True)], axis=1)
            rest = []
            for i, a, b in zip(going, lo, hi, strict=True):
                wide = radius[i] > 2.0
                hit = np.ones(len(self.vectors), bool) if wide else self.collisions(a, b) >= need
                fresh = np.flatnonzero(hit & ~seen[i])
                near[i] = np.concatenate([near[i], away(i, fresh)])
                seen[i, fresh] = True
                if not wide and np.count_nonzero(near[i] <= radius[i] ** 2) <= cfg.k:
                    rest.append(i)
            going = np.array(rest, dtype=np.int64)
            radius *= cfg.growth
        yield from map(np.flatnonzero, seen)


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector has only finite components, not all of them zero."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return df.where(x.isNotNull() & finite & F.exists(x, lambda v: v != 0))


def nearest(vectors: DataFrame, queries: DataFrame, cfg: AnnConfig = AnnConfig()) -> DataFrame:
    """The ``cfg.k`` nearest rows of ``vectors`` (vec_id, embedding) found for each row of
    ``queries`` (the same columns): query_id, rank, vec_id, score.

    Nearness is the largest inner product in double precision, ties to the smaller
    vec_id; a query's own vec_id is no candidate. Vectors that are null, zero, or hold a
    null or non-finite component take no part; vectors meet those of their own dimension.
    Repeated rows of a vec_id count once. Fewer candidates than ``k``: all of them.
    """
    pick = [F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")]
    # repeated rows go first: a block is bounded whatever vec_id they repeat
    base, asked = usable(vectors.where("vec_id is not null").select(*pick)).dropDuplicates(["vec_id", "embedding"]), usable(queries.where("vec_id is not null").select(*pick))
    groups = max(1, -(-base.count() // cfg.block_vectors))
    dim = F.size("embedding")
    rows = base.select(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(groups)).cast("int").alias("g"), dim.alias("dim"), F.lit(False).alias("asks"), "vec_id", "embedding")
    asks = asked.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), dim.alias("dim"), F.lit(True).alias("asks"), "vec_id", "embedding")

    def search(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        """Rows come by block and dimension, vectors before queries."""
        block, ids, parts, index = None, [], [], None
        for batch in batches:
            g, d, asking = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("g", "dim", "asks"))
            at = np.unique(np.concatenate([runs(g), runs(d), runs(asking), np.arange(0, len(g), cfg.block_queries)]))
            for a, b in zip(at[:-1], at[1:], strict=True):
                if (g[a], d[a]) != block:
                    block, ids, parts, index = (g[a], d[a]), [], [], None
                own = batch.slice(a, b - a)
                x = own.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(b - a, -1)
                names = own.column("vec_id").to_numpy(zero_copy_only=False)
                if not asking[a]:
                    ids.append(names)
                    parts.append(x)
                elif parts or index:
                    if index is None:
                        index, ids, parts = CollisionIndex(np.concatenate(parts), cfg), np.concatenate(ids), []
                    yield from nearest_in(index, ids, x, names)

    def nearest_in(index: CollisionIndex, v_ids: np.ndarray, q: np.ndarray, q_ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for row, hit in enumerate(index.search(q)):
            hit = hit[v_ids[hit] != q_ids[row]]
            score = np.einsum("ij,j->i", index.vectors[hit], q[row])
            top = np.lexsort((v_ids[hit], -score))
            _, first = np.unique(v_ids[hit][top], return_index=True)
            top = top[np.sort(first)][: cfg.k]
            out.append((np.full(len(top), q_ids[row]), v_ids[hit][top], score[top]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["query_id", "vec_id", "score"])

    keys = ("g", "dim")
    met = rows.unionByName(asks).repartition(groups, *keys).sortWithinPartitions(*keys, "asks")
    found = met.mapInArrow(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= cfg.k).select("query_id", "rank", "vec_id", "score")


def op6_ann(embeddings: DataFrame, cfg: AnnConfig = AnnConfig()) -> DataFrame:
    return nearest(embeddings, embeddings.where(F.col("vec_id") % 20 == 0), cfg)
