"""A prefix trie of conversations by burst tries.

A conversation is the sequence of its turns' ids. Where more sequences pass a node than a container
may hold, the container bursts by the next turn id: the node becomes a trie head, and each next turn
starts a container of the suffixes behind it. Heads are few (bounded below), whatever the table's
size; containers are dealt to shards by their start, sorted inside them and swept into nodes with
one path in memory. Heads get their figures from the sums of the containers below them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.core.io import materialize, table

#: Sequences that a container may hold before it bursts, and a bound on the number of heads.
CAPACITY, HEADS = 128, 1 << 16
#: A turn's id: 16 bytes of MD5 and 8 bytes with the length of its text in UTF-8.
WIDTH = 24
NO_ENDS = hashlib.sha256(b"").hexdigest()
ROOT = bytes(16)


def sequences(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, seq): each conversation's turn ids in one binary, by turn; ties by role, then text.

    Null roles and texts are empty; a null turn comes first; repeated rows are turns of their own;
    rows without a conversation id take no part. A conversation's rows are sorted in one task and
    read in a stream, so that it needs 24 bytes a turn of memory however long its texts are.
    """
    d = rows.select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).where("conv_id IS NOT NULL")
    size = F.octet_length("text").cast("long")
    said = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"))
    token = F.concat(F.unhex(said), F.unhex(F.lpad(F.hex(size), 16, "0")))
    d = d.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", token.alias("token"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[int, bytes]] = []
        held, now, parts = 0, None, []
        give = lambda: pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], pa.int64()), pa.array([s for _, s in done], pa.binary())], names=["conv_id", "seq"])
        for batch in batches:
            for c, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if c != now:
                    if parts:
                        done.append((now, b"".join(parts)))
                        held += len(done[-1][1])
                        if held > 4 << 20 or len(done) > 8192:
                            yield give()
                            done, held = [], 0
                    now, parts = c, []
                parts.append(t)
        if parts:
            done.append((now, b"".join(parts)))
        if done:
            yield give()

    return d.mapInArrow(run, "conv_id long, seq binary")


def rebuilt(own: DataFrame) -> DataFrame:
    """(conv_id, seq): the first h turns of conversation c - c % 5, then c's own behind its first h,
    where h = crc32(decimal c) % 9. At most five conversations ask for the same one."""
    base = own.select(F.col("conv_id").alias("base"), F.col("seq").alias("begin"))
    d = own.withColumns({"base": F.expr("conv_id - conv_id % 5"), "h": F.expr(f"CAST({WIDTH} * (crc32(CAST(conv_id AS STRING)) % 9) AS INT)")})
    return d.join(base, "base", "left").select("conv_id", F.expr("concat(coalesce(substring(begin, 1, h), X''), substring(seq, h + 1))").alias("seq"))


def ends_digests(keyed: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of each key's decimal conv_ids, ascending and comma-joined.

    Ids are range-partitioned by key and id and written out in runs there, so a key of very many ids
    is read and rendered by many tasks; one task then digests its runs in a stream, as SHA-256 of
    one text cannot be divided.
    """

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: list[tuple[bytes, int, str]] = []
        now, ids = None, []
        give = lambda: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*runs), (pa.binary(), pa.int64(), pa.string()))], names=["key", "first", "ids"])
        for batch in batches:
            for key, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != now or len(ids) == 1000:
                    if ids:
                        runs.append((now, ids[0], ",".join(map(str, ids))))
                        if len(runs) == 2000:
                            yield give()
                            runs = []
                    now, ids = key, []
                ids.append(c)
        if ids:
            runs.append((now, ids[0], ",".join(map(str, ids))))
        if runs:
            yield give()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[bytes, str]] = []
        now, sha = None, hashlib.sha256()
        give = lambda: pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([s for _, s in done])], names=["key", "ends_sha256"])
        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != now:
                    if now is not None:
                        done.append((now, sha.hexdigest()))
                        if len(done) == 10_000:
                            yield give()
                            done = []
                    now, sha = key, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
        if now is not None:
            done.append((now, sha.hexdigest()))
            yield give()

    runs = keyed.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(render, "key binary, first long, ids string")
    return runs.repartition("key").sortWithinPartitions("key", "first").select("key", "ids").mapInArrow(hashed, "key binary, ends_sha256 string")


def _next(node: bytes, token: bytes) -> bytes:
    return hashlib.md5(node + token).digest()


def _walk(seq: bytes, heads: dict) -> tuple[bytes, int]:
    """The deepest head on a sequence's path from the root, and its depth."""
    node, depth = ROOT, 0
    for at in range(0, len(seq), WIDTH):
        below = _next(node, seq[at : at + WIDTH])
        if below not in heads:
            break
        node, depth = below, depth + 1
    return node, depth


def burst(distinct: DataFrame, capacity: int = CAPACITY, most_heads: int = HEADS) -> tuple[dict[bytes, tuple[bytes, int, int]], int]:
    """The trie's heads: {node: (parent, depth, bytes of its last text)}, and the container capacity.

    Containers start at the root. Each round looks at those that stopped at the depth where the
    round before ended and bursts them turn by turn over a window of depths that doubles with every
    round, so long shared beginnings need few rounds. As every sequence passes one node a depth,
    there are at most (all turns) / capacity heads; capacity grows where that would exceed
    ``most_heads``, and the driver's table of heads stays small.
    """
    total = distinct.agg(F.sum(F.octet_length("seq") / WIDTH)).first()[0] or 0
    capacity = max(capacity, int(total // most_heads) + 1)
    context = distinct.sparkSession.sparkContext
    heads: dict[bytes, tuple[bytes, int, int]] = {ROOT: (b"", 0, 0)}
    low, width, asked = 0, 8, {ROOT}
    while asked:
        shared = context.broadcast((asked, heads))

        def count(batches: Iterator[pa.RecordBatch], low=low, high=low + width, shared=shared) -> Iterator[pa.RecordBatch]:
            asked, heads = shared.value
            seen: dict[bytes, list] = {}
            kinds = [pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int64()]
            names = ["node", "parent", "depth", "bytes", "n"]
            give = lambda: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*[(k, *v) for k, v in seen.items()]), kinds)], names=names)
            for batch in batches:
                for seq in batch.column(0).to_pylist():
                    node, depth = _walk(seq[: low * WIDTH], heads)
                    if depth != low or node not in asked:
                        continue
                    for at in range(low * WIDTH, min(len(seq), high * WIDTH), WIDTH):
                        token = seq[at : at + WIDTH]
                        below = _next(node, token)
                        if below in seen:
                            seen[below][3] += 1
                        else:
                            seen[below] = [node, at // WIDTH + 1, int.from_bytes(token[16:], "big"), 1]
                        node = below
                    if len(seen) > 100_000:
                        yield give()
                        seen = {}
            if seen:
                yield give()

        counted = distinct.select("seq").mapInArrow(count, "node binary, parent binary, depth int, bytes long, n long")
        over = counted.groupBy("node").agg(F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("bytes").alias("bytes"), F.sum("n").alias("n")).where(F.col("n") > capacity)
        found = {bytes(r["node"]): (bytes(r["parent"]), r["depth"], r["bytes"]) for r in over.collect()}
        heads |= found
        low, width = low + width, 2 * width
        asked = {k for k, v in found.items() if v[1] == low}
    return heads, capacity


NODE = "head binary, conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
NODE_KINDS = [pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]


class _Open:
    """A node on the path that the sweep is on."""

    __slots__ = ("token", "depth", "n", "low", "leaves", "saved", "children", "ends")

    def __init__(self, token: bytes, depth: int):
        self.token, self.depth = token, depth
        self.n = self.leaves = self.saved = 0
        self.low, self.children, self.ends = None, [], NO_ENDS

    def row(self, head: bytes | None, parent: int | None) -> tuple:
        return (head, self.low, self.depth, parent, self.n, len(self.children), self.leaves, self.saved, self.ends)


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted containers to nodes: each node when the last sequence through it has passed.

    Rows (head, start, depth, suffix, n, conv_id, ends_sha256) by container and suffix. Memory holds
    the open path and the finished children of its nodes. A container's top node keeps the ``head``
    that it hangs on; all other nodes know their parent's smallest conversation.
    """
    out: list[tuple] = []
    path: list[_Open] = []
    now: tuple | None = None
    names = [c.split()[0] for c in NODE.split(", ")]
    give = lambda: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), NODE_KINDS)], names=names)

    def close(keep: int) -> None:
        while len(path) > keep:
            x = path.pop()
            x.leaves = x.leaves if x.children else 1
            x.saved += (x.n - 1) * int.from_bytes(x.token[16:], "big")
            out.extend(c.row(None, x.low) for c in x.children)
            x.children = [None] * len(x.children)
            if path:
                up = path[-1]
                up.children.append(x)
                up.n, up.leaves, up.saved = up.n + x.n, up.leaves + x.leaves, up.saved + x.saved
                up.low = x.low if up.low is None else min(up.low, x.low)
            else:
                out.append(x.row(now[0], None))

    for batch in batches:
        for head, start, depth, suffix, n, conv, ends in zip(*[c.to_pylist() for c in batch.columns]):
            if now is None or now[1] != start:
                close(0)
                now = (head, start)
            at = 0
            while at < len(path) and path[at].token == suffix[at * WIDTH : (at + 1) * WIDTH]:
                at += 1
            close(at)
            for k in range(at, len(suffix) // WIDTH):
                path.append(_Open(suffix[k * WIDTH : (k + 1) * WIDTH], depth + k))
            last = path[-1]
            last.n, last.ends = last.n + n, ends
            last.low = conv if last.low is None else min(last.low, conv)
            if len(out) > 50_000:
                yield give()
                out = []
    close(0)
    if out:
        yield give()


def prefix_trie(seqs: DataFrame, capacity: int = CAPACITY, most_heads: int = HEADS) -> DataFrame:
    """The nodes of the prefix trie of (conv_id, seq); a conv_id is on one row, an empty seq ends at
    the root.

    Columns: conv_id (smallest member; with depth it names the node), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256, as the query's contract says.
    Equal sequences are one row from the start, so copies weigh as one in a container. No
    conversations give no nodes, not even a root.
    """
    spark = seqs.sparkSession
    keyed = materialize(seqs.select("conv_id", "seq", F.unhex(F.md5("seq")).alias("key")), "trie-sequences")
    distinct = keyed.groupBy("key", "seq").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))
    distinct = materialize(distinct.join(ends_digests(keyed), "key"), "trie-distinct")
    heads, capacity = burst(distinct, capacity, most_heads)
    shared = spark.sparkContext.broadcast(heads)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads = shared.value
        kinds = [pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            rows = []
            for seq, n, conv, ends in zip(*[c.to_pylist() for c in batch.columns]):
                head, depth = _walk(seq, heads)
                suffix = seq[depth * WIDTH :]
                start = _next(head, suffix[:WIDTH]) if suffix else None
                rows.append((head, start, depth + 1, suffix, n, conv, ends))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["head", "start", "depth", "suffix", "n", "conv_id", "ends_sha256"])

    placed = distinct.select("seq", "n", "conv_id", "ends_sha256").mapInArrow(place, "head binary, start binary, depth int, suffix binary, n long, conv_id long, ends_sha256 string")
    placed = materialize(placed, "trie-containers")
    shards = placed.where("start IS NOT NULL").repartition("start").sortWithinPartitions("start", "suffix")
    nodes = materialize(shards.mapInArrow(sweep, NODE), "trie-nodes")
    top = _heads(heads, nodes, placed)
    if not top:
        return nodes.drop("head")
    low = spark.createDataFrame([(k, v["low"]) for k, v in top.items()], "head binary, above long")
    rows = [(v["low"], v["depth"], top[v["parent"]]["low"] if v["depth"] else None, v["n"], v["children"], v["leaves"], v["saved"], v["ends"]) for v in top.values()]
    tops = spark.createDataFrame(rows, "conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    # Heads are bounded by ``most_heads``; only containers' tops carry one.
    found = nodes.join(F.broadcast(low), "head", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return found.select(*tops.columns).unionByName(tops)


def _heads(heads: dict, nodes: DataFrame, placed: DataFrame) -> dict[bytes, dict]:
    """The figures of the heads, deepest first, from one row of sums a head."""
    below = nodes.where("head IS NOT NULL").groupBy("head").agg(F.sum("n_convs").alias("n"), F.min("conv_id").alias("low"), F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    ended = placed.where("start IS NULL").select("head", "n", "conv_id", "ends_sha256")
    top = {k: {"parent": p, "depth": d, "bytes": b, "n": 0, "low": None, "children": 0, "leaves": 0, "saved": 0, "ends": NO_ENDS} for k, (p, d, b) in heads.items()}
    least = lambda a, b: b if a is None else a if b is None else min(a, b)
    for r in below.collect():
        v = top[bytes(r["head"])]
        v["n"] += r["n"]
        v["low"] = least(v["low"], r["low"])
        for what in ("children", "leaves", "saved"):
            v[what] += r[what]
    for r in ended.collect():
        v = top[bytes(r["head"])]
        v["n"] += r["n"]
        v["low"], v["ends"] = least(v["low"], r["conv_id"]), r["ends_sha256"]
    for k in sorted(top, key=lambda k: -top[k]["depth"]):
        v = top[k]
        v["leaves"] = v["leaves"] if v["children"] else 1
        v["saved"] += (v["n"] - 1) * v["bytes"]
        if v["depth"]:
            up = top[v["parent"]]
            up["n"] += v["n"]
            up["low"] = least(up["low"], v["low"])
            up["children"] += 1
            up["leaves"] += v["leaves"]
            up["saved"] += v["saved"]
    return top if top[ROOT]["n"] else {}


def op13_burst_trie(spark, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    own = materialize(sequences(table(spark, sf_dir, "conversations")), "trie-turns")
    found = prefix_trie(rebuilt(own))
    return found.withColumn("depth", F.col("depth").cast("long"))


OP13_SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, list_reduce(flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
           lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END, CAST(4294967295 AS BIGINT)) AS crc
  FROM (SELECT DISTINCT conv_id FROM turns)
), convs AS (
  SELECT conv_id, xor(crc, 4294967295) % 9 AS h FROM ids
), made AS (
  SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
), again AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS depth, md5(strlen(role) || ':' || role || text) AS said, strlen(text) AS bytes FROM made
), path AS (
  SELECT conv_id, depth, md5(string_agg(said, '' ORDER BY depth) OVER (PARTITION BY conv_id ORDER BY depth)) AS node, bytes FROM again
  UNION ALL SELECT conv_id, 0, 'root', 0 FROM convs
), long AS (
  SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM path
), nodes AS (
  SELECT node, any_value(depth) AS depth, any_value(parent) AS parent, any_value(bytes) AS bytes, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM long GROUP BY node
), kids AS (
  SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), sums AS (
  SELECT p.node, count(*) FILTER (k.node IS NULL) AS n_leaves, sum((x.n_convs - 1) * x.bytes) AS saved_tokens
  FROM nodes x JOIN path p ON p.conv_id = x.conv_id AND p.depth <= x.depth LEFT JOIN kids k ON k.node = x.node GROUP BY p.node
)
SELECT x.conv_id, CAST(x.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, x.n_convs, coalesce(k.n_children, 0) AS n_children,
       s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, x.ends_sha256
FROM nodes x JOIN sums s ON s.node = x.node LEFT JOIN kids k ON k.node = x.node LEFT JOIN nodes u ON u.node = x.parent
"""
