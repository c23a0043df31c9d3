"""WARC salvage, ball-tree search and burst tries: brute force, damaged bytes and odd inputs."""

import gzip
import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from tarnworks.llm import balltree, bursttrie, warc

PAGES = "page_id long, url string, html string, sha string, keeper long, n long"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 7, 8) for r in rows], PAGES)


def read_pages(df):
    got = warc.read_archives(warc.write_archives(warc.marked(df), archive_bytes=3000)).collect()
    assert {r["kind"] for r in got} <= {"record"}
    page = lambda s: None if s is None or s.split(":")[2] == "null" else int(s.split(":")[2])
    return sorted(((page(r["record_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], page(r["refers_to"])) for r in got if r["record_type"] != "warcinfo"), key=str)


def plain_pages(rows):
    largest = {}
    for i, _, h in rows:
        key = (h or "").encode()
        largest[key] = max((x for x in (largest.get(key), i) if x is not None), default=None)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        keeper = largest[raw]
        again = keeper is not None and i != keeper
        out.append((i, len(raw), warc.digest(raw), "revisit" if again else "response", keeper if again else None))
    return sorted(out, key=str)


def test_pages_and_revisits(spark):
    rows = [(1, "http://a/\r\nx y", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (None, "u", "<p>é</p>"), (None, "u", "alone"), (None, "u", "alone"), (9, "u", "z"), (9, "u", "z"), (9, "u", "other"), (10, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 500)]
    rows += [(100 + i, "u", f"pair {i // 2}") for i in range(2400)]  # no payload holds a thousandth of the repeated rows
    rows += [(5000 + i, "u", "hot") for i in range(40)]
    assert read_pages(pages_of(spark, rows)) == plain_pages(rows)
    assert read_pages(pages_of(spark, [])) == []


def test_shorter_payloads_are_no_revisits(spark):
    got = {r["page_id"]: r["keeper"] for r in warc.marked(pages_of(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]), least=3).collect()}
    assert got == {1: None, 2: None, 3: 4, 4: None}


def test_revisited_payloads(spark, tmp_path):
    rows = [(i, "u", f"text {i % 3} " * 50) for i in range(9)]
    for r in warc.write_archives(warc.marked(pages_of(spark, rows)), archive_bytes=500).collect():
        (tmp_path / r["archive"]).write_bytes(r["content"])
    files = spark.read.format("binaryFile").load(f"{tmp_path}/*.warc.gz")
    back = warc.with_revisited(warc.read_archives(files, "path", "content", payloads=True)).where("record_type <> 'warcinfo'").collect()
    assert sorted((int(r["record_id"].split(":")[2]), bytes(r["payload"]).decode()) for r in back) == [(i, h) for i, _, h in rows]


def record_of(i, text):
    raw = text.encode()
    return warc.page_record(i, f"http://x/{i}", raw, len(raw), hashlib.sha1(raw).hexdigest(), None)


def ids_and_gaps(data):
    got = list(warc.salvage(data))
    ids = [int(x.headers["warc-record-id"].split(":")[2]) for x in got if isinstance(x, warc.Record)]
    return ids, [(x.offset, x.length, x.reason) for x in got if isinstance(x, warc.Gap)]


@pytest.mark.parametrize("compress", [True, False])
def test_salvage_finds_all_but_the_damaged(compress):
    rng = np.random.default_rng(4)
    pack = gzip.compress if compress else bytes
    records = [pack(record_of(i, "".join(rng.choice(list("abc WARC/1.\r\n"), 300)))) for i in range(12)]
    starts = np.cumsum([0, *map(len, records)])
    for case in range(150):
        data = bytearray(b"".join(records))
        hit = sorted(rng.choice(12, rng.integers(1, 4), replace=False))
        for k in hit:
            if case % 3 == 0:
                data[starts[k] + rng.integers(20, len(records[k]) - 20)] ^= 1 << int(rng.integers(8))
            else:
                lo = int(rng.integers(0, len(records[k]) - 5))
                data[starts[k] + lo : starts[k] + lo + 5] = bytes(rng.integers(0, 256, 5, dtype=np.uint8))
        got = list(warc.salvage(bytes(data)))
        ids = [int(np.searchsorted(starts, x.offset)) for x in got if isinstance(x, warc.Record)]
        gaps = [x for x in got if isinstance(x, warc.Gap)]
        clean = [k for k in range(12) if bytes(data[starts[k] : starts[k + 1]]) == records[k] or k not in hit]
        assert set(clean) <= set(ids)  # header bytes that no check covers may change
        lost = set(range(12)) - set(ids)
        assert sum(x.length for x in gaps) == sum(len(records[k]) for k in lost), (case, gaps)


def test_salvage_reasons():
    a, b = record_of(1, "one"), record_of(2, "two")
    assert ids_and_gaps(b"") == ([], [])
    assert ids_and_gaps(b"nothing here") == ([], [(0, 12, "no version line")])
    assert ids_and_gaps(a[:-10] + b) == ([2], [(0, len(a) - 10, "no end mark")])
    assert ids_and_gaps(a + b[:-10]) == ([1], [(len(a), len(b) - 10, "record is cut off")])
    assert ids_and_gaps(a.replace(b"one\r\n", b"onf\r\n") + b) == ([2], [(0, len(a), "block digest differs")])
    both = gzip.compress(a + b)
    assert ids_and_gaps(both + b"\0" * 30 + gzip.compress(b)) == ([1, 2, 2], [(len(both), 30, "no version line")])
    long = gzip.compress(b"".join(record_of(i, np.random.default_rng(i).bytes(3000).hex()) for i in range(20)))
    ids, gaps = ids_and_gaps(long[: len(long) // 2] + gzip.compress(b))
    assert ids[:9] == list(range(9)) and ids[-1] == 2 and len(gaps) == 1  # records before a member's damage are kept


# Ball trees.


def plain_search(docs, items, k):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    told = [(i, cut(t)) for i, t in docs]
    n_docs, n_terms = sum(1 for _, t in told if t), sum(len(t) for _, t in told)
    df = {}
    for _, t in told:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    wanted = {}
    for i, t in items:
        if i is not None:
            wanted.setdefault(i, set()).update(cut(t))
    out = []
    for item, own in wanted.items():
        scored = []
        for i, t in told:
            if t:
                m = 10 + (90 * len(t) * n_docs) // n_terms
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * t.count(w)) // (1000 * t.count(w) + 8 * m)) for w in own if w in t)
                scored += [(-s, -(2**63) if i is None else i)] if s > 0 else []
        out += [(item, r + 1, None if i == -(2**63) else i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("shard_docs,block_bytes,k", [(1000, 1 << 20, 10), (50, 100, 3), (7, 1 << 20, 1)])
def test_ranked_search_against_brute_force(spark, shard_docs, block_bytes, k):
    rng = np.random.default_rng(5)
    words = ["Alpha", "beta", "ünïcode", "42", "x", *[f"w{i}" for i in range(60)]]
    text = lambda n: " ".join(rng.choice(words, n, p=(p := 1 / np.arange(1, len(words) + 1)) / p.sum()))
    docs = [(i, text(rng.integers(1, 40))) for i in range(200)]
    docs += [(i + 300, docs[i][1]) for i in range(40)] + [(7, "Alpha,alpha;ALPHA"), (7, "Alpha,alpha;ALPHA"), (None, docs[3][1]), (None, "beta"), (500, None), (501, ""), (502, " -- "), (503, "x " * 30_000), (504, docs[9][1] * 3)]
    items = [(i, docs[i * 7][1]) for i in range(20)] + [(3, "extra w50"), (30, None), (31, "absent words"), (None, "beta"), (32, "w59"), (32, "w59")]
    d = spark.createDataFrame([(*r, 1, "t") for r in docs], "doc_id long, text string, n long, terms string")
    q = spark.createDataFrame([(*r, 5) for r in items], "item_id long, text string, rank int")
    got = [tuple(r) for r in balltree.ranked_search(d, q, k=k, shard_docs=shard_docs, block_bytes=block_bytes).collect()]
    assert sorted(got, key=str) == plain_search(docs, items, k)
    assert balltree.ranked_search(d.limit(0), q).count() == 0 and balltree.ranked_search(d, q.limit(0)).count() == 0


def test_subtrees_are_pruned():
    rng = np.random.default_rng(6)
    n_terms, rows = 400, []
    for topic in range(20):  # documents of a topic share its terms
        rows += [(rng.choice(20, 8, replace=False) + 20 * topic, rng.integers(1, 10**9, 8)) for _ in range(100)]
    at = np.arange(len(rows) + 1) * 8
    spaces = np.arange(n_terms) // 20
    shard = balltree.Shard(np.arange(len(rows)), at, np.concatenate([t for t, _ in rows]), np.concatenate([g for _, g in rows]), spaces)
    query, best = np.arange(40, 60), []
    scored = shard.search(query, spaces[query], 10, best)
    dense = np.array([sum(int(g) for t, g in zip(*r) if t in query) for r in rows])
    assert sorted(best, reverse=True) == sorted(((int(s), -i) for i, s in enumerate(dense) if s > 0), reverse=True)[:10]
    leaves = sum(left < 0 for _, _, left, _ in shard.nodes)
    assert scored <= leaves // 5


# Burst tries.


def plain_trie(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((-math.inf if turn is None else turn, (role or "").encode(), (text or "").encode()))
    own = {c: [(r, t) for _, r, t in sorted(v)] for c, v in convs.items()}
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    made = {c: tuple(own.get(int(c - math.fmod(c, 5)), [])[: h[c]] + own[c][h[c] :]) for c in own}
    members = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = []
    for node, convs in members.items():
        below = [x for x in members if x[: len(node)] == node]
        kids = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(y[: len(x)] == x and len(y) > len(x) for y in below)]
        saved = sum((len(members[x]) - 1) * (len(x[-1][1]) if x else 0) for x in below)
        ends = ",".join(map(str, sorted(c for c in convs if made[c] == node)))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(spark, rows, **limits):
    d = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, seq string")
    return sorted(tuple(r) for r in bursttrie.prefix_trie(bursttrie.rebuilt(bursttrie.sequences(d)), **limits).select(*NAMES).collect())


def talks(rng, n, turns, texts):
    return [(c, k, "user" if k % 2 == 0 else "assistant", str(rng.choice(texts))) for c in range(n) for k in range(rng.integers(1, turns))]


@pytest.mark.parametrize("capacity", [1, 3, 1024])
def test_trie_against_brute_force(spark, capacity):
    rng = np.random.default_rng(7)
    rows = talks(rng, 80, 12, ["a", "ß", "", "long " * 30])
    rows += [(200 + i, k, "user", "same") for i in range(12) for k in range(25)]  # copies of a long one
    rows += [(300 + i, k, "user", "same" if k < 20 + i else f"own {i}") for i in range(9) for k in range(30)]  # branches of a long stem
    rows += [(-7, 0, "user", "neg"), (-7, 1, "b", "neg"), (400, None, None, None), (400, 1, "a", None), (401, 1, "a", "x"), (401, 1, "a", "x"), (401, 1, "A", "y"), (None, 0, "user", "a"), (403, 0, "u", "v")]
    assert trie(spark, rows, capacity=capacity) == plain_trie(rows)


def test_heads_stay_few(spark):
    rows = talks(np.random.default_rng(8), 120, 9, ["a", "b"])
    assert trie(spark, rows, capacity=1, most_heads=5) == plain_trie(rows)
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    heads, capacity = bursttrie.burst(bursttrie.sequences(d).dropDuplicates(["seq"]), 1, 5)
    assert len(heads) <= 6 and capacity > 1


def test_trie_of_nothing(spark):
    assert trie(spark, []) == []
