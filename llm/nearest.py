"""Approximate nearest neighbours by collision counting over query-centred hash windows."""

from __future__ import annotations

from math import erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import materialize, ship_code

#: Projections, window width at radius 1, radius growth, and the first radius (of unit vectors).
PROJECTIONS, WIDTH, GROWTH, FIRST_RADIUS = 96, 1.5, 1.15, 0.4
#: An object at the radius is a candidate unless its collisions fall this many standard
#: deviations under their mean (97.7 %).
DEVIATIONS = 2.0
#: Errors of single precision cosines of unit vectors, by component.
SLACK = 1e-6
#: Vectors and queries that one task holds.
BLOCK_VECTORS, BLOCK_QUERIES = 8192, 2048


def collision_threshold(m: int, width: float, deviations: float) -> int:
    """Collisions of m that an object at exactly the radius reaches (almost always)."""
    p = erf(width / 2 / sqrt(2))
    return max(1, int(np.floor(m * p - deviations * sqrt(m * p * (1 - p)))))


class BlockIndex:
    """The projections of a block of vectors, those of each hash function side by side."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, m: int = PROJECTIONS, seed: int = 11):
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.hashes = np.random.default_rng(seed).standard_normal((vectors.shape[1], m))
        unit = vectors / self.norms[:, None]
        self.values = np.ascontiguousarray((unit @ self.hashes).T, dtype=np.float32)
        # for a first look at candidates, within SLACK of their cosines
        self.unit = unit.astype(np.float32) if np.isfinite(unit).all() and np.isfinite(self.norms).all() else None

    def cosines(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        return (self.vectors[at] * query).sum(axis=1) / (self.norms[at] * np.sqrt((query * query).sum()))

    def nearest(self, query_id: int, query: np.ndarray, k: int, width: float = WIDTH) -> tuple[np.ndarray, np.ndarray]:
        """Indices and cosines of the ``k`` nearest found, the query's own id left out.

        The radius grows; at each the windows around the query's projections widen, and objects whose
        collisions (projections within the window) reach the threshold are verified. It ends when k
        verified objects lie within the radius, or with all objects verified."""
        m, n = self.values.shape
        need = collision_threshold(m, width, DEVIATIONS)
        unit = query / np.sqrt((query * query).sum())
        gaps = np.abs(self.values - (unit @ self.hashes).astype(np.float32)[:, None])
        open_ = self.ids != query_id
        found, scores = np.zeros(0, np.int64), np.zeros(0)
        radius = FIRST_RADIUS
        while open_.any():
            if radius > 2:  # every unit vector lies within
                new = np.flatnonzero(open_)
            else:
                within = (gaps <= np.float32(width * radius / 2)).view(np.uint8)
                new = np.flatnonzero(open_ & (within.sum(axis=0, dtype=np.uint8 if m < 256 else np.int64) >= need))
            open_[new] = False
            new = self.promising(new, unit, scores, k)
            found = np.concatenate([found, new])
            scores = np.concatenate([scores, self.cosines(new, query)])
            best = np.lexsort((self.ids[found], -scores))[:k]
            found, scores = found[best], scores[best]
            if len(found) == k and sqrt(max(0.0, 2 - 2 * scores.min())) <= radius:
                break
            radius *= GROWTH
        return found, scores

    def promising(self, new: np.ndarray, unit: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Those of the candidates ``new`` that can be among the k best of them and of what has ``scores``:
        in single precision the cosines of all are cheap, and only what comes near the k-th needs the exact one."""
        if self.unit is None or len(new) + len(scores) <= k or not np.isfinite(unit).all():
            return new
        rough = self.unit[new] @ unit.astype(np.float32)
        both = np.concatenate([scores, rough])
        return new[rough >= np.partition(both, len(both) - k)[len(both) - k] - SLACK * (1 + len(unit))]


def usable_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part; the least of a repeated vec_id."""
    v = F.col("embedding")
    good = (F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    return (embeddings.where(good).select(F.col("vec_id").cast("long"), v.cast("array<double>").alias("embedding"))
            .groupBy("vec_id").agg(F.min("embedding").alias("embedding")))


def nearest_vectors(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """The ``k`` nearest by cosine of each row whose vec_id is divisible by ``every``, among all
    other rows: query_id, rank, vec_id, score. Ties go to the smaller vec_id.

    Vectors and queries are dealt into blocks of bounded size and each pair of blocks is one
    task, which indexes its vectors and searches its queries; the blocks' results are merged.
    Of equal vectors only the k + 1 of least vec_id are indexed, as no others can be in a result
    (the limit is applied before the shuffle, so a vector that a third of the rows hold is no
    hot group). Scores are cosines of the original vectors in double precision.

    Rows with a null vec_id, and vectors null, empty, zero or with null or non-finite components,
    take no part. Rows that repeat a vec_id are one, with the least vector. Only vectors of the
    same length meet. An empty table gives no rows; other columns are ignored.
    """
    ship_code(embeddings.sparkSession)
    rows = materialize(usable_vectors(embeddings), "vectors")
    n = rows.count()
    blocks, query_blocks = -(-max(n, 1) // BLOCK_VECTORS), -(-max(n // every, 1) // BLOCK_QUERIES)
    copies = Window.partitionBy("embedding").orderBy("vec_id")
    indexed = rows.withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= k + 1).drop("_copy")
    dim = F.size("embedding").alias("_dim")
    deal = lambda c, parts: F.pmod(F.xxhash64(c), F.lit(parts)).cast("int")
    span = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = indexed.select("vec_id", "embedding", dim, deal("vec_id", blocks).alias("_block"), span(query_blocks).alias("_queries"))
    right = (rows.where(F.col("vec_id") % every == 0)
             .select("vec_id", "embedding", dim, span(blocks).alias("_block"), deal("vec_id", query_blocks).alias("_queries")))

    def search(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        def matrix(t):
            return t["vec_id"].to_numpy(), t["embedding"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)

        out: tuple[list, ...] = ([], [], [])
        if vectors.num_rows and queries.num_rows:
            index = BlockIndex(*matrix(vectors))
            for query_id, query in zip(*matrix(queries)):
                found, scores = index.nearest(query_id, query, k)
                out[0].append(np.full(len(found), query_id))
                out[1].append(index.ids[found])
                out[2].append(scores)
        cols = [np.concatenate(c) if c else np.zeros(0) for c in out]
        return pa.table([pa.array(cols[0].astype(np.int64)), pa.array(cols[1].astype(np.int64)), pa.array(cols[2].astype(np.float64))],
                        names=["query_id", "vec_id", "score"])

    keys = ["_dim", "_block", "_queries"]
    hits = (left.groupBy(*keys).cogroup(right.groupBy(*keys))
            .applyInArrow(search, "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
