"""Exact top-k inner-product search with MaxScore over sharded inverted indexes.

Every (dimension, sign) is a term with a posting list of the vectors that have a
component of that sign. A shard of candidates is indexed once, inside one task; the queries
stream through every shard's index, and the shards' top lists are merged by Spark.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.core.io import table

SCALE = 1024


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """(id, v): components floor(scale * x) as longs.

    Left out: null ids, null vectors, vectors with a null, NaN or infinite component.
    Rows that repeat an id with the same vector count once; an id's different vectors are rows
    of their own.
    """
    d = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return (
        d.where(F.col("id").isNotNull() & F.col("v").isNotNull())
        .where(~bad)
        .select("id", F.transform("v", lambda x: F.floor(x * scale)).alias("v"))
    )


class ShardIndex:
    """Inverted index of one shard: for each dimension a posting list per sign."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.columns = np.ascontiguousarray(rows.T)
        self.plus = [np.flatnonzero(c > 0) for c in self.columns]
        self.minus = [np.flatnonzero(c < 0) for c in self.columns]
        self.top = self.columns.max(axis=1, initial=0)
        self.low = self.columns.min(axis=1, initial=0)

    def _scores(self, docs: np.ndarray, q: np.ndarray) -> np.ndarray:
        return self.rows[docs] @ q

    def search(self, own: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best vectors, without those whose id is ``own``."""
        q = q[: self.rows.shape[1]]
        q = np.pad(q, (0, self.rows.shape[1] - len(q)))
        dims = np.flatnonzero(q)
        # Terms (bound, dim, list, sign of the products). Negative products have bound 0.
        terms = []
        for d in dims:
            gain, loss = (self.plus[d], self.minus[d]) if q[d] > 0 else (self.minus[d], self.plus[d])
            terms.append((int(q[d] * (self.top[d] if q[d] > 0 else self.low[d])), d, gain, 1))
            terms.append((0, d, loss, -1))
        terms.sort(key=lambda t: t[0])
        bounds = np.cumsum([t[0] for t in terms]) if terms else np.zeros(0, np.int64)
        theta = self._first_threshold(own, q, terms, k)
        # Vectors in non-essential lists alone stay below theta: theta > their bounds' sum.
        # Where even an empty vector (score 0) may compete, every vector is traversed.
        if theta is None or theta <= 0:
            essential, docs = 0, np.arange(len(self.ids))
        else:
            essential = int(np.searchsorted(bounds, theta, side="left"))
            docs = None
        partial = np.zeros(len(self.ids), np.int64)
        touched = np.zeros(len(self.ids), bool)
        for _, d, posting, _ in terms[essential:]:
            partial[posting] += self.columns[d][posting] * q[d]
            touched[posting] = True
        docs = np.flatnonzero(touched) if docs is None else docs
        docs = docs[self.ids[docs] != own]
        score = partial[docs]
        for i in range(essential - 1, -1, -1):  # probe, highest bound first
            keep = score + bounds[i] >= theta
            docs, score = docs[keep], score[keep]
            if not len(docs):
                break
            _, d, _, sign = terms[i]
            value = self.columns[d][docs] * q[d]
            score = score + (np.maximum(value, 0) if sign > 0 else np.minimum(value, 0))
        order = np.lexsort((self.ids[docs], -score))[:k]
        return self.ids[docs[order]], score[order]

    def _first_threshold(self, own: int, q: np.ndarray, terms: list, k: int) -> int | None:
        """The k-th best of the vectors that lead the highest-bound lists, scored whole."""
        pool = []
        for _, d, posting, _ in terms[-4:]:
            if len(posting):
                value = self.columns[d][posting] * q[d]
                n = min(len(posting), 4 * k + 1)
                pool.append(posting[np.argpartition(-value, n - 1)[:n]])
        docs = np.unique(np.concatenate(pool)) if pool else np.zeros(0, np.int64)
        docs = docs[self.ids[docs] != own]
        if len(docs) < k:
            return None
        return int(np.partition(self._scores(docs, q), len(docs) - k)[len(docs) - k])


def _matrix(rows: pd.Series) -> np.ndarray:
    width = max((len(x) for x in rows), default=0)
    out = np.zeros((len(rows), width), np.int64)
    for i, x in enumerate(rows):
        out[i, : len(x)] = x
    return out


def _searched(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """Answers of rows sorted by shard, a shard's candidates before the queries: a shard is indexed
    once, when its first query comes, and the queries stream through the index."""
    shard, held, index = None, [], None
    for batch in batches:
        out = []
        for key, rows in batch.groupby("shard", sort=False):
            if key != shard:
                shard, held, index = key, [], None
            if len(own := rows[~rows["asked"]]):
                held.append(own)
            for query_id, v in rows.loc[rows["asked"], ["id", "v"]].itertuples(index=False):
                if index is None and held:
                    whole = pd.concat(held)
                    index, held = ShardIndex(whole["id"].to_numpy(), _matrix(whole["v"])), []
                if index is not None:
                    ids, score = index.search(query_id, np.asarray(v, np.int64), k)
                    out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids, "score": score}))
        if out:
            yield pd.concat(out)


def maxscore_topk(
    candidates: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = 10,
    scale: int = SCALE,
    shard_rows: int = 8192,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best candidates, exactly.

    Score: integer inner product of floor(scale * x); ties go to the smaller id; a
    query's own id is no candidate. Vectors of unequal length: missing components are 0.
    Fewer than k candidates: all of them. An id with several vectors can take several ranks,
    and as a query has the best of all its vectors' scores. See ``integer_vectors`` for what takes no part;
    no queries or no candidates give no rows. A candidate is in one shard, of about ``shard_rows``
    (their number follows from a count), which bounds what one task holds; queries go to every
    shard and pass its index in batches.
    """
    c = integer_vectors(candidates, id_col, vec_col, scale).dropDuplicates()
    q = integer_vectors(queries, id_col, vec_col, scale).dropDuplicates()
    shards = max(1, math.ceil(c.count() / shard_rows))
    # By id and vector: an id with many vectors is spread over all shards.
    dealt = c.select(F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("asked"), "id", "v")
    sent = q.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("asked"), "id", "v")
    rows = dealt.unionByName(sent).repartition("shard").sortWithinPartitions("shard", "asked")
    found = rows.mapInPandas(lambda batches: _searched(batches, k), "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op9_maxscore_topk(spark, sf_dir: str) -> DataFrame:
    """Each hundredth vector's ten best inner products among all other vectors."""
    e = table(spark, sf_dir, "embeddings")
    return maxscore_topk(e, e.where(F.col("vec_id") % 100 == 0))


OP9_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
