r"""Chat formatting over a prefix tree of conversations.

Conversations that share their first turns share those turns' segments. Each segment's
tokens are stored once; segments in depth-first order, tree after tree, give one token
stream. A segment carries its place in that stream, the position id of its first token
(its depth in tokens along its own path) and the intervals of the stream that its tokens
may attend to: its ancestors' ones, and its own up to the token itself.

Template of a turn: ``### <role>: <text></turn>\n``. In texts and roles a backslash
escapes a backslash, ``###``, ``</turn>``; in roles also ``:``. Tokens are a byte-level
BPE's ids, taken apart at the header's and the text's ends so that the loss mask falls
on token bounds.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.core.io import materialize, table

OPEN, CLOSE = "### ", "</turn>\n"
CONTROL = r"(\\|###|</turn>)"
ROLE_CONTROL = r"(\\|###|</turn>|:)"

def escape(text: str, control: str = CONTROL) -> str:
    return re.sub(control, r"\\\1", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\|###|</turn>|:)", r"\1", text)


def conversation_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's (role, text) pairs by turn; ties by role, then text.

    Null roles and texts are empty; a null turn comes first; rows with a null conversation
    id form one conversation. Repeated rows are turns of their own.
    """
    d = rows.select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    return d.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))


def prefix_nodes(turns: DataFrame) -> DataFrame:
    """(conv_id, at, node, role, text): a row for each turn; ``node`` digests all turns so far, so
    equal beginnings have equal nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, turns in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, node = [], b""
                for at, t in enumerate(turns.as_py()):
                    role, text = t["role"].encode(), t["text"].encode()
                    node = hashlib.sha256(node + b"%d %d " % (len(role), len(text)) + role + text).digest()[:16]
                    rows.append((conv, at, node.hex(), t["role"], t["text"]))
                names = ["conv_id", "at", "node", "role", "text"]
                kinds = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return turns.select("conv_id", "turns").mapInArrow(run, "conv_id long, at int, node string, role string, text string")


_encodings: dict[str, object] = {}


def _encoding(path: str):
    """The byte-level BPE of a rank file, in the form that tiktoken reads."""
    if path not in _encodings:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[path] = tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


SEGMENT = "conv_id long, leaf boolean, owned boolean, seg string, path array<string>, n long, tokens array<int>, masked array<struct<lo:int,hi:int>>"


def segments(nodes: DataFrame, tokenizer: str) -> DataFrame:
    """The segments of each conversation: runs of turns that the same conversations share.

    Where two turns in a row belong to equally many conversations, all that reach the first
    reach the second, so a run has no branch inside. ``seg`` is a run's first node, ``path`` the
    segments from the root to it. One conversation of those that share a segment owns it and
    carries its tokens and the places of its loss mask; ``leaf`` marks a conversation's last.
    """
    key = F.coalesce("conv_id", F.lit(-(2**63)))
    # Most nodes are one conversation's own; the others are written, so that the join can divide a
    # node that very many conversations share.
    shared = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("n_convs"), F.min(key).alias("owner")).where("n_convs > 1")
    rows = nodes.join(materialize(shared, "chat-shared"), "node", "left")
    rows = rows.withColumns({"n_convs": F.coalesce("n_convs", F.lit(1)), "owner": F.coalesce("owner", key)}).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "node", "n_convs", "owner", "role", "text"))).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(tokenizer).encode_ordinary
        close = encode(CLOSE)
        names = [c.split()[0] for c in ("conv_id", "leaf", "owned", "seg", "path", "n", "tokens", "masked")]
        span = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
        kinds = [pa.int64(), pa.bool_(), pa.bool_(), pa.string(), pa.list_(pa.string()), pa.int64(), pa.list_(pa.int32()), span]
        for batch in batches:
            for conv, turns in zip(batch.column(0).to_pylist(), batch.column(1)):
                out, before, mine = [], None, conv if conv is not None else -(2**63)
                for t in turns.as_py():
                    if t["n_convs"] != before:
                        path = [*(out[-1][4] if out else []), t["node"]]
                        out.append([conv, False, t["owner"] == mine, t["node"], path, 0, [], []])
                        before = t["n_convs"]
                    if out[-1][2]:
                        tokens = out[-1][6]
                        tokens += encode(OPEN + escape(t["role"], ROLE_CONTROL) + ": ")
                        lo = len(tokens)
                        tokens += encode(escape(t["text"]))
                        if t["role"] == "assistant":
                            out[-1][7].append({"lo": lo, "hi": len(tokens)})
                        tokens += close
                        out[-1][5] = len(tokens)
                out[-1][1] = True
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return rows.mapInArrow(run, SEGMENT)


def prefix_tree(cut: DataFrame) -> DataFrame:
    """The trees' segments with their tokens once each, in depth-first order.

    Columns: seg, path, tokens, masked, n, start (place of the first token in the stream),
    position (its position id), attend (intervals [lo, hi) of the stream that its tokens may
    attend to: its ancestors', then its own, causal inside; adjacent ones are one). Trees of
    any size: places are prefix sums over range-partitioned segments, so no tree has to fit in
    a task.
    """
    coded = cut.where("owned").select("seg", "path", "tokens", "masked", "n")
    slim = coded.select("seg", F.array_join("path", "").alias("place"), "path", "n")
    # Depth-first order is the order of paths. Range partitions of it are written with their
    # number: a running sum inside each, and before it the sums of those before.
    part = slim.repartitionByRange("place").withColumn("part", F.spark_partition_id())
    part = materialize(part, "chat-ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = part.groupBy("part").agg(F.sum("n").alias("total"))
    sums = sums.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        part.withColumn("within", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(sums, "part")
        .select("seg", "path", "n", (F.col("offset") + F.col("within")).alias("start"))
    )
    placed = materialize(placed, "chat-places")
    # Each segment's ancestors: one row a path entry, met by the entry's own place.
    entry = placed.select("seg", F.posexplode("path").alias("at", "above"))
    spans = placed.select(F.col("seg").alias("above"), "start", "n")
    above = (
        entry.join(spans, "above")
        .groupBy("seg")
        .agg(
            F.sort_array(F.collect_list(F.struct("at", F.col("start").alias("lo"), (F.col("start") + F.col("n")).alias("hi")))).alias("spans"),
            F.sum("n").alias("reach"),
        )
    )
    own = F.element_at("spans", -1)
    empty = F.array().cast("array<struct<lo:bigint,hi:bigint>>")
    joined = F.aggregate(
        "spans",
        empty,
        lambda seen, s: F.when(
            F.coalesce(F.try_element_at(seen, F.lit(-1))["hi"] == s["lo"], F.lit(False)),
            F.concat(F.slice(seen, 1, F.size(seen) - 1), F.array(F.struct(F.try_element_at(seen, F.lit(-1))["lo"].alias("lo"), s["hi"].alias("hi")))),
        ).otherwise(F.concat(seen, F.array(F.struct(s["lo"].alias("lo"), s["hi"].alias("hi"))))),
    )
    return coded.join(above, "seg").select("seg", "path", "tokens", "masked", "n", own["lo"].alias("start"), (F.col("reach") - F.col("n")).alias("position"), joined.alias("attend"))


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, attended long"


def read_back(leaves: DataFrame, tree: DataFrame, tokenizer: str) -> DataFrame:
    """Each conversation read from the tree's tokens: those that its last segment attends to.

    ``leaves`` is (conv_id, path). Returns the decoded turns' digests; the loss mask covers
    the text tokens of assistant turns.
    """
    entry = leaves.select("conv_id", F.explode("path").alias("seg"))
    got = entry.join(tree.select("seg", "tokens", "masked", "position", "attend"), "seg")
    whole = got.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("position", "tokens", "masked"))).alias("parts"), F.max_by("attend", "position").alias("attend"))
    whole = whole.withColumn("attended", F.aggregate("attend", F.lit(0).cast("long"), lambda a, s: a + s["hi"] - s["lo"])).drop("attend")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = _encoding(tokenizer)
        for pdf in batches:
            rows = []
            for conv, parts, attended in zip(pdf["conv_id"], pdf["parts"], pdf["attended"]):
                tokens, masked = [], []
                for p in parts:
                    own = list(p["tokens"])
                    tokens += own
                    masked += [unescape(coder.decode(own[m["lo"] : m["hi"]])) for m in p["masked"]]
                if len(tokens) != attended:
                    raise ValueError(f"conversation {conv}: {len(tokens)} tokens, {attended} attended")
                whole = coder.decode(tokens)
                turns = _parse(whole)
                told = "".join(f"{r}\n{t}\n" for r, t in turns)
                loss = "".join(masked)
                rows.append((conv, len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(whole), attended))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in READ.split(", ")]).astype({"conv_id": "Int64"})

    return whole.mapInPandas(run, READ)


#: A turn in formatted text: header up to the first bare ": ", text up to the first bare end.
_TURN = re.compile(r"### ((?:\\(?:\\|###|</turn>|:)|[^\\:])*): ((?:\\(?:\\|###|</turn>)|(?!</turn>)[^\\])*)</turn>\n", re.S)


def _parse(text: str) -> list[tuple[str, str]]:
    out, at = [], 0
    while at < len(text):
        m = _TURN.match(text, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


#: The conversation that every run formats besides the table's: its texts hold control strings.
PROBE = (-7, r"\### Assistant: </turn> ok")


def op5_chat_tree(spark, sf_dir: str) -> DataFrame:
    """All conversations and the probe, formatted over a prefix tree and read back from it. Rows of
    the table that have the probe's id join its conversation."""
    import public_tokenizers

    tokenizer = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(PROBE[0], i, r, PROBE[1]) for i, r in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    turns = conversation_turns(rows.unionByName(probe))
    cut = materialize(segments(materialize(prefix_nodes(turns), "chat-nodes"), tokenizer), "chat-segments")
    tree = materialize(prefix_tree(cut), "chat-tree")
    return read_back(cut.where("leaf").select("conv_id", "path"), tree, tokenizer).drop("attended")


OP5_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), one AS (
  SELECT *, '### ' || regexp_replace(role, '(\\|###|</turn>|:)', '\\\1', 'g') || ': '
         || regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g') || '</turn>' || chr(10) AS formatted
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(formatted)) AS BIGINT) AS formatted_chars
FROM one GROUP BY conv_id
"""
