"""Exact top-k inner-product search over an impact-ordered index, score at a time.

Vectors are cut into blocks; each block's index holds postings (dimension, vector,
value) for the components of its vectors, in segments of one quantised impact (the
number of bits of the value's size), and for every vector the length of what
the segments below leave out.  A block's index is built once, then the queries pass
it in groups: segments are added to the scores in descending impact; by
Cauchy-Schwarz the rest of a score is at most |query| times that length, so a vector
whose upper bound is under the k-th best lower bound is proven out.  A query stops
only when what may still belong to its k best is few (or no segment is left); those
members are then scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapscope.llm.common import importable, quoted, release
from gapscope.session import materialize

#: Vectors of an index block, and queries that are answered together over it.
BLOCK, QUERIES = 4096, 512
#: Bound of a scaled component's size: products of 2^13 components then add up within 64 bits.
LARGEST = 1 << 25
#: Possible members at which a query goes on to exact scores.
FEW = 48


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, as array<bigint>; null if the vector is null or has a null or non-finite
    component; an error for components of 2^25 or more."""
    x = F.transform(vector, lambda v: v.cast("double"))
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    small = F.forall(x, lambda v: F.abs(F.floor(v * scale)) < LARGEST)
    too_large = F.raise_error(F.lit(f"a vector's scaled component is {LARGEST} or more")).cast("array<bigint>")
    return F.when(sound, F.when(small, F.transform(x, lambda v: F.floor(v * scale))).otherwise(too_large))


@dataclass
class Index:
    """Impact-ordered postings of a block of vectors."""

    vectors: np.ndarray
    segments: list[tuple[np.ndarray, np.ndarray]]  # by descending impact: the vectors that have postings, their values by dimension
    left: list[np.ndarray]  # after each segment: the length of what is not yet added, by vector


def build_index(vectors: np.ndarray) -> Index:
    impact = np.frexp(np.abs(vectors).astype(np.float64))[1]  # 0 has no posting: it never adds to a score
    segments, left, rest = [], [], (vectors.astype(np.float64) ** 2).sum(1)
    for level in np.unique(impact[vectors != 0])[::-1]:
        postings = np.where((impact == level) & (vectors != 0), vectors, 0)
        have = np.flatnonzero(postings.any(1))
        segments.append((have, postings[have].astype(np.float64)))
        rest = rest - (postings.astype(np.float64) ** 2).sum(1)
        left.append(np.sqrt(np.maximum(rest, 0)))
    return Index(vectors, segments, left)


def search(index: Index, rows: np.ndarray, queries: np.ndarray, query_rows: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every query the places of its ``k`` best (more on ties) and their exact scores; its own row is left out."""
    n, norm = len(rows), np.sqrt((queries.astype(np.float64) ** 2).sum(1))
    at = np.searchsorted(rows, query_rows)   # rows are in ascending order
    own_q = np.flatnonzero((at < n) & (rows[np.minimum(at, n - 1)] == query_rows))
    answer: list = [None] * len(queries)
    live, scores = np.arange(len(queries)), np.zeros((len(queries), n))
    scores[own_q, at[own_q]] = -np.inf
    whole = np.median(np.sqrt((index.vectors.astype(np.float64) ** 2).sum(1))) if n else 0
    for step in range(max(1, len(index.segments))):
        last, left = step >= len(index.segments) - 1, np.zeros(n)
        if index.segments:
            have, postings = index.segments[step]
            scores[:, have] += queries[live].astype(np.float64) @ postings.T
            left = index.left[step]
        if not last and np.median(left) > 0.35 * whole:
            continue  # nothing can be proven yet
        slack = norm[live][:, None] * left * (1 + 1e-9)  # room for rounding of the lengths
        lower = scores - slack
        mark = np.partition(lower, n - k, 1)[:, n - k] if n > k else np.full(len(live), -np.inf)
        upper = np.add(scores, slack, out=slack)
        possible = (upper >= mark[:, None]) & (upper > -np.inf)
        done = (possible.sum(1) <= max(FEW, k)) | last
        for i in np.flatnonzero(done):
            members = np.flatnonzero(possible[i])
            answer[live[i]] = members, index.vectors[members] @ queries[live[i]]
        live, scores = live[~done], scores[~done]
        if not len(live):
            break
    return answer


def _matrix(vectors: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _vectors(column: pa.Array) -> list[np.ndarray]:
    flat, cut = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(cut, cut[1:])]


def top_k(df: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding",
          scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest integer inner products of every query row with all other rows.

    Components are floor(``scale`` * x); scores are whole numbers, ties go to the
    smaller id; fewer than ``k`` candidates are all returned.  Rows whose vector
    is null or holds a null or non-finite component, and rows without an id, take
    no part.  Vectors of unequal length count as filled up with 0, empty ones
    too.  A query is a row: rows that share an id ask each for themselves and
    are candidates of each other.  A component of 2^25 or more after scaling is
    an error.  Other columns are not read.
    """
    importable(df.sparkSession)
    rows = df.select(F.col(quoted(vec_id)).cast("long").alias("vec_id"), quantised(F.col(quoted(vector)), scale).alias("v"),
                     F.coalesce(is_query, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("row"))
    rows = materialize(rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()), "vectors")
    blocks = max(1, -(-rows.count() // BLOCK))
    candidates = rows.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), F.lit(False).alias("asks"), "row", "vec_id", "v")
    asked = rows.where("asks").select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(True).alias("asks"), "row", "vec_id", "v")
    # to every block its vectors, each once, then all queries
    met = candidates.unionByName(asked).repartition("block").sortWithinPartitions("block", "asks", "row")
    names = ["query", "query_id", "vec_id", "score"]

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, index, ids, own, waiting = None, None, None, None, []

        def told() -> Iterator[pa.RecordBatch]:
            nonlocal index, ids, own
            if not waiting:
                return
            if isinstance(index, list):  # all of the block's vectors are there
                width = max(len(v) for _, _, v in [*index, *waiting])
                own, ids = (np.array([r[c] for r in index], np.int64) for c in (0, 1))
                index = build_index(_matrix([r[2] for r in index], width)) if len(ids) else None
            if index is not None:
                width = max(index.vectors.shape[1], max(len(v) for _, _, v in waiting))
                if width > index.vectors.shape[1]:  # zeros change no score
                    index.vectors = np.pad(index.vectors, ((0, 0), (0, width - index.vectors.shape[1])))
                    index.segments = [(have, np.pad(p, ((0, 0), (0, width - p.shape[1])))) for have, p in index.segments]
                asks = np.array([r[0] for r in waiting], np.int64)
                out = search(index, own, _matrix([r[2] for r in waiting], width), asks, k)
                best = [np.lexsort((ids[m], -exact))[:k] for m, exact in out]
                some = [len(b) for b in best]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(asks, some)), pa.array(np.repeat(np.array([r[1] for r in waiting], np.int64), some)),
                    pa.array(np.concatenate([ids[m[b]] for (m, _), b in zip(out, best)])),
                    pa.array(np.concatenate([exact[b] for (_, exact), b in zip(out, best)]))], names=names)
            waiting.clear()

        for batch in batches:
            for of, asks, row, vec, v in zip(*(batch.column(c).to_numpy(zero_copy_only=False) for c in range(4)), _vectors(batch.column(4))):
                if of != block:
                    yield from told()
                    block, index = of, []
                if not asks:
                    index.append((row, vec, v))
                    continue
                waiting.append((row, vec, v))
                if len(waiting) == QUERIES:
                    yield from told()
        yield from told()
        release()

    best = met.mapInArrow(answer, "query long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: The query's rows in DuckDB: all scores, ranked.
ORACLE = """
WITH whole AS (
  SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.id, q.vec_id AS query_id, c.vec_id, CAST(coalesce(CASE WHEN len(q.v) = len(c.v) AND len(q.v) > 0 THEN list_dot_product(q.v, c.v)
      ELSE list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) END, 0) AS BIGINT) AS score
  FROM (SELECT * FROM whole WHERE vec_id % 50 = 0) q JOIN whole c ON q.id <> c.id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
