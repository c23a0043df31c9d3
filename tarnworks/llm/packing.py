"""Packing: optimal length buckets and token-budget batches.

The histogram of all lengths is one grouped aggregation; dynamic programming over it
chooses the bucket bounds with the least padding. Inside a bucket every batch holds as
many documents, padded to the bucket's bound, as the token budget allows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.core.io import materialize, table

TOKEN_BUDGET = 16_384
BUCKETS = 8
#: Hash classes in which a bucket's documents are numbered side by side.
CLASSES = 1024


def word_count(text):
    """Words of a text column: runs without white space; null: none."""
    t = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    return F.when(t == "", 0).otherwise(F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1).cast("long")


def optimal_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets over the distinct lengths (ascending, as often
    as ``counts`` says) with the least total padding; ties prefer fewer, then smaller bounds.

    Layer by layer; the best last cut moves right with the end (padding satisfies the
    quadrangle inequality), so halving the range of ends makes a layer n log n.
    """
    n = len(lengths)
    if not n:
        return []
    length = np.asarray(lengths, np.int64)
    count = np.concatenate(([0], np.cumsum(counts)))
    tokens = np.concatenate(([0], np.cumsum(length * counts)))
    # padding of lengths i..j-1 in one bucket: length[j-1] * (count) - tokens
    best = np.concatenate(([0], length * count[1:] - tokens[1:]))
    cuts = []
    layers = [best]
    for _ in range(1, min(buckets, n)):
        new, cut = best.copy(), np.zeros(n + 1, np.int64)
        todo = [(1, n, 0, n - 1)]
        while todo:
            lo, hi, first, last = todo.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(first, min(last, j - 1) + 1)
            cost = best[i] + length[j - 1] * (count[j] - count[i]) - (tokens[j] - tokens[i])
            k = int(np.argmin(cost))
            new[j], cut[j] = cost[k], i[k]
            todo += [(lo, j - 1, first, int(i[k])), (j + 1, hi, int(i[k]), last)]
        cuts.append(cut)
        layers.append(new)
        best = new
    used = min(range(len(layers)), key=lambda k: (layers[k][n], k))
    bounds, j = [], n
    for k in range(used, -1, -1):
        bounds.append(int(length[j - 1]))
        j = int(cuts[k - 1][j]) if k else 0
        if not j:
            break
    return bounds[::-1]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = TOKEN_BUDGET, buckets: int = BUCKETS, length=None) -> DataFrame:
    """(id, n_tokens, bucket, padded_to, batch, slot): each document's place in a batch.

    ``length``: a Column that counts a row's tokens; words by default. The histogram holds every
    document's length; buckets number from 0 by bound, batches from 0 inside each, all full but
    the last. A batch holds as many documents, padded to the bucket's bound, as fit ``budget``,
    and one at least: a document may be longer than the budget. Empty documents count as one
    token of padding. Null ids and repeated rows are documents like others; which of two equal
    ids and lengths comes first is open. The driver holds the histogram: lengths that differ are
    fewer than the square root of twice the corpus's tokens.
    """
    n = word_count(F.col(text_col)) if length is None else length
    d = docs.select(F.col(id_col).alias(id_col), n.cast("long").alias("n_tokens"), F.pmod(F.xxhash64(id_col, text_col), F.lit(CLASSES)).cast("int").alias("class"))
    d = materialize(d.withColumn("size", F.greatest("n_tokens", F.lit(1))), "pack-lengths")
    rows = d.groupBy("size").count().orderBy("size").toPandas()
    bounds = optimal_bounds(rows["size"].to_numpy(), rows["count"].to_numpy(), buckets)
    bucket, padded = F.lit(None).cast("int"), F.lit(None).cast("long")
    for i in reversed(range(len(bounds))):
        bucket = F.when(F.col("size") <= bounds[i], i).otherwise(bucket)
        padded = F.when(F.col("size") <= bounds[i], bounds[i]).otherwise(padded)
    d = d.withColumns({"bucket": bucket.cast("int"), "padded_to": padded.cast("long")})
    # A document's number in its bucket: those of the classes before, and its own in its class.
    # The classes' counts are at most buckets * CLASSES rows.
    before = Window.partitionBy("bucket").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    counts = d.groupBy("bucket", "class").count()
    offsets = counts.select("bucket", "class", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    own = Window.partitionBy("bucket", "class").orderBy("size", id_col)
    numbered = d.withColumn("rank", F.row_number().over(own)).join(F.broadcast(offsets), ["bucket", "class"])
    numbered = numbered.withColumn("number", F.col("offset") + F.col("rank") - 1)
    room = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("padded_to")))
    return numbered.select(
        id_col,
        "n_tokens",
        "bucket",
        "padded_to",
        F.floor(F.col("number") / room).cast("long").alias("batch"),
        (F.col("number") % room).cast("int").alias("slot"),
    )


def op2_optimal_buckets(spark, sf_dir: str) -> DataFrame:
    """Every document's bucket, batch and slot."""
    return pack(table(spark, sf_dir, "documents"))
