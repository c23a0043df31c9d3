r"""Ranked lexical search: exact inner products of sparse vectors with ball trees.

A document's vector has an integer weight for each term, a query's a weight for each of its terms;
the score is their inner product. Documents are cut into shards; a shard's tree halves its documents
by two far ones until a leaf is small, and every node keeps a centroid c and radii. Balls are drawn
around vectors that carry the query's term weights already (the query is then 0 or 1 a term), so
that common terms, which score little, take little of a radius. A single ball prunes nothing in
thousands of dimensions, so the space is a sum of subspaces g with a radius r_g each: the terms that
one query alone has form its own, every other term is one. A node's documents score at most
q.c + sum over g of |q_g| r_g. Subtrees are visited best bound first until the bound falls below the
k-th best score that the task has seen; leaves are scored in integers.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.core.io import materialize, table

#: Bytes of query texts that one pass over the documents serves; documents of a shard and of a leaf.
BLOCK_BYTES, SHARD_DOCS, LEAF_DOCS = 1 << 19, 4096, 32
#: Every byte of UTF-8 that is in no term becomes a space, A-Z become a-z.
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Stands for a null document id; it comes before all others.
NO_ID = -(2**63)
#: Rounding of a bound: doubles of at most some thousand terms err by far less.
SLACK = 1e-9


def terms(text: str | None) -> list[bytes]:
    """The maximal runs of letters, digits and characters beyond ASCII; A-Z lower-cased."""
    return (text or "").encode().translate(TERMS).split()


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, terms, counts): all terms of each whole text counted, those of a vocabulary listed."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            sizes, ids, counts = [], [], []
            for text in batch.column(1):
                words = terms(text.as_py())
                sizes.append(len(words))
                own = [(known[w], c) for w, c in Counter(words).items() if w in known]
                ids.append([i for i, _ in own])
                counts.append([c for _, c in own])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))], names=["doc_id", "n", "terms", "counts"]
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>")


class Shard:
    """The ball tree of some documents in CSR form: ``at[i]:at[i+1]`` are document i's entries."""

    def __init__(self, ids: np.ndarray, at: np.ndarray, terms: np.ndarray, gains: np.ndarray, spaces: np.ndarray, leaf: int = LEAF_DOCS):
        # Terms that the shard has, numbered anew: centroids need no room for others.
        self.map = np.full(len(spaces), -1, np.int64)
        present = np.unique(terms)
        self.map[present] = np.arange(len(present))
        terms = self.map[terms]
        values = gains.astype(np.float64)
        norms = np.add.reduceat(np.append(values * values, 0.0), at[:-1]) if len(ids) else np.zeros(0)
        there, space = np.unique(spaces[present], return_inverse=True)  # the subspace of each term
        self.space = np.full(int(spaces.max(initial=0)) + 1, -1, np.int64)
        self.space[there] = np.arange(len(there))
        self.nodes: list[tuple[int, int, int, int]] = []  # (first, last + 1) place in order, children
        centroids, order = [], np.arange(len(ids))
        lengths = np.diff(at)

        def entries(docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Places of the documents' entries, and where each document's begin among them."""
            n = lengths[docs]
            starts = np.concatenate([[0], np.cumsum(n)[:-1]])
            return np.repeat(at[docs] - starts, n) + np.arange(n.sum()), starts

        def distances(docs: np.ndarray, where: np.ndarray, starts: np.ndarray, point: np.ndarray) -> np.ndarray:
            dot = np.add.reduceat(values[where] * point[terms[where]], starts)
            return norms[docs] + point @ point - 2 * dot

        def radii(docs: np.ndarray, where: np.ndarray, starts: np.ndarray, point: np.ndarray) -> np.ndarray:
            """No less than the largest distance to the point in each subspace: squares of
            differences, and what a document lacks of the point's own square."""
            n = len(there)
            key = np.repeat(np.arange(len(docs)) * n, lengths[docs]) + space[terms[where]]
            on = point[terms[where]]
            inside = np.bincount(key, (values[where] - on) ** 2, len(docs) * n).reshape(-1, n)
            whole = np.bincount(space, point * point, n)
            outside = np.maximum(whole - np.bincount(key, on * on, len(docs) * n).reshape(-1, n), 0.0) + SLACK * whole
            return np.sqrt((inside + outside).max(axis=0)) * (1 + SLACK)

        reach: dict[int, np.ndarray] = {}
        stack = [(0, len(ids), -1, 0)] if len(ids) else []
        while stack:
            lo, hi, parent, side = stack.pop()
            me = len(self.nodes)
            self.nodes.append((lo, hi, -1, -1))
            if parent >= 0:
                a, b, left, right = self.nodes[parent]
                self.nodes[parent] = (a, b, me, right) if side == 0 else (a, b, left, me)
            docs = order[lo:hi]
            where, starts = entries(docs)
            centre = (np.bincount(terms[where], values[where], len(present)) / len(docs)).astype(np.float32)
            point = centre.astype(np.float64)
            centroids.append(centre)
            if hi - lo <= leaf:
                reach[me] = radii(docs, where, starts, point)
                continue
            far = [int(np.argmax(distances(docs, where, starts, point)))]
            to = []
            for k in range(2):
                pole = np.zeros(len(present))
                own = slice(at[docs[far[k]]], at[docs[far[k]] + 1])
                pole[terms[own]] = values[own]
                to.append(distances(docs, where, starts, pole))
                far.append(int(np.argmax(to[0])))
            gap = to[0] - to[1]
            near = gap < 0
            if not leaf // 2 <= near.sum() <= len(docs) - leaf // 2:  # a few far ones, or copies: halve by rank
                near = np.zeros(len(docs), bool)
                near[np.argsort(gap, kind="stable")[: max(leaf // 2, min(int((gap < 0).sum()), len(docs) - leaf // 2))]] = True
            order[lo:hi] = np.concatenate([docs[near], docs[~near]])
            middle = lo + int(near.sum())
            stack += [(middle, hi, me, 1), (lo, middle, me, 0)]
        where, starts = entries(order)
        self.ids = ids[order]
        self.terms, self.gains = terms[where], gains[where]
        self.at = np.append(starts, len(where)).astype(np.int64)
        self.centroids = np.ascontiguousarray(np.array(centroids, np.float32).reshape(len(self.nodes), len(present)).T)
        for me in range(len(self.nodes) - 1, -1, -1):  # children come after their parent
            if me not in reach:
                far_off = [np.sqrt(np.bincount(space, (centroids[c].astype(np.float64) - centroids[me]) ** 2, len(there))) + reach[c] for c in self.nodes[me][2:]]
                reach[me] = np.maximum(*far_off) * (1 + SLACK)
        self.radii = np.array([reach[me] for me in range(len(self.nodes))]).reshape(len(self.nodes), len(there)).T.copy()
        self.mark = np.zeros(len(present), np.int64)

    def search(self, query: np.ndarray, spaces: np.ndarray, k: int, best: list[tuple[int, int]]) -> int:
        """Improve ``best``, a heap of (score, -id) of at most ``k``, by the shard's documents.

        ``query`` are its terms, ``spaces`` their subspaces. Returns how many leaves were scored.
        """
        own = self.map[query]
        in_space = self.space[spaces[own >= 0]]
        own = own[own >= 0]
        if not len(own):
            return 0
        bounds = self.centroids[own].sum(axis=0, dtype=np.float64)
        asked, n = np.unique(in_space, return_counts=True)
        bounds = (bounds + np.sqrt(n) @ self.radii[asked]) * (1 + SLACK) + 1.0
        scored = 0
        open_nodes = [(-bounds[0], 0)]
        self.mark[own] = 1
        while open_nodes:
            bound, node = heapq.heappop(open_nodes)
            if len(best) == k and -bound < best[0][0]:
                break
            lo, hi, left, right = self.nodes[node]
            if left >= 0:
                heapq.heappush(open_nodes, (-bounds[left], left))
                heapq.heappush(open_nodes, (-bounds[right], right))
                continue
            scored += 1
            a, b = self.at[lo], self.at[hi]
            score = np.add.reduceat(self.gains[a:b] * self.mark[self.terms[a:b]], self.at[lo:hi] - a)
            least = best[0][0] if len(best) == k else 1
            for i in np.flatnonzero(score >= max(least, 1)):
                found = (int(score[i]), -int(self.ids[lo + i]))
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
        self.mark[own] = 0
        return scored


def subspaces(queries: list[np.ndarray], n_terms: int) -> np.ndarray:
    """The subspace of each term: one for the terms that a single query has, one for any other term."""
    n, last = np.zeros(n_terms, np.int64), np.zeros(n_terms, np.int64)
    for i, q in enumerate(queries):
        n[q] += 1
        last[q] = i
    return np.where(n == 1, last, len(queries) + np.arange(n_terms))


def _search(counted: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int, queries: list[tuple[int, np.ndarray]], k: int, shard_docs: int) -> DataFrame:
    spaces = subspaces([q for _, q in queries], len(weights))
    shared = counted.sparkSession.sparkContext.broadcast((weights, spaces, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, spaces, queries = shared.value
        best: list[list[tuple[int, int]]] = [[] for _ in queries]
        for batch in batches:
            for lo in range(0, batch.num_rows, shard_docs):
                part = batch.slice(lo, shard_docs)
                ids = part.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
                n = part.column(1).to_numpy(zero_copy_only=False)
                lists = part.column(2)
                at = lists.offsets.to_numpy().astype(np.int64)
                at = at - at[0]
                own = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                tf = part.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                m = 10 + (90 * n * n_docs) // n_terms
                gains = weights[own] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, np.diff(at))))
                shard = Shard(ids, at, own, gains, spaces)
                for (_, query), found in zip(queries, best):
                    shard.search(query, spaces[query], k, found)
        rows = [(item, -i, score) for (item, _), found in zip(queries, best) for score, i in found]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["item_id", "doc_id", "score"])

    return counted.where(F.size("terms") > 0).mapInArrow(run, "item_id long, doc_id long, score long")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    k: int = 10,
    block_bytes: int = BLOCK_BYTES,
    shard_docs: int = SHARD_DOCS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents with a score above 0, exactly.

    Terms, weights and scores as the query's contract says; equal scores by ascending doc_id, a null
    id first. Every row of ``docs`` is a document of its own, so an id that repeats can take several
    ranks; a null or empty text has no terms. Several rows of an item count as one text; rows
    without an item id take no part. Items come in blocks of about ``block_bytes`` of text; each
    block reads the documents' texts once, keeps the counts of the block's terms in a written table
    and searches that. No items or no documents give no rows.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).where("item_id IS NOT NULL")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    found = None
    for block in range(blocks):
        wanted: dict[int, set[bytes]] = {}
        for r in asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect():
            wanted.setdefault(r["item_id"], set()).update(terms(r["text"]))
        vocabulary = {w: i for i, w in enumerate(sorted(set().union(*wanted.values())))}
        if not vocabulary:
            continue
        counted = materialize(term_counts(docs, vocabulary, id_col, text_col), "search-counts")
        n_docs, n_terms = counted.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            continue
        df = np.zeros(len(vocabulary), np.int64)
        for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row a term of the block
            df[r["term"]] = r["count"]
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        queries = [(item, np.array(sorted(vocabulary[w] for w in own), np.int64)) for item, own in sorted(wanted.items())]
        best = _search(counted, weights, n_docs, n_terms, queries, k, shard_docs)
        found = best if found is None else found.unionByName(best)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    w = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    top = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return top.select("item_id", "rank", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score")


def op12_ball_tree_search(spark, sf_dir: str) -> DataFrame:
    """Each benchmark item's ten best documents."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents
), t AS (
  SELECT r, doc_id, len(ts) AS n, unnest(ts) AS term FROM d
), tf AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM t GROUP BY ALL
), s AS (
  SELECT count(*) AS big_n, CAST(sum(len(ts)) AS BIGINT) AS big_l FROM d WHERE len(ts) > 0
), w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, s GROUP BY term, big_n
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL
), scored AS (
  SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term), s GROUP BY item_id, r, doc_id
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
