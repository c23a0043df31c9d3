"""BPE, media, chat, packing and licences: brute force, round trips and odd inputs."""

import hashlib
import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnworks.llm import bpe, chat, license, media, packing

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

TEXTS = [
    None, "", "   ", "Hello, world! It's 42.", "ÉTÉ naïve ΣΑΣ İstanbul", "a<|endoftext|>b <|startoftext|>", "x" * 3000, "tab\tnew\nline nbsp",
    "😀👩‍👩‍👧 ok", "!!!???...", "the the the", "Ünïcödé ½ ² Ⅷ", "don't WE'RE 's's", "a\ufa6cb \ufa6c1!", "é𝐀𝟏\U0001e475 b",
]


def docs(spark, texts=TEXTS):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(None, "null id", None, None), (3, texts[3 % len(texts)], "x", "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens string")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, ids string, n_tokens string")


def test_bpe_equals_the_library(spark):
    path = P.path("word_bpe_49k.json")
    t = tokenizers.Tokenizer.from_file(path)
    d = docs(spark)
    got = sorted(map(tuple, bpe.encode(d, path).select("doc_id", "n_tokens", "ids", "decoded").collect()), key=str)
    want = []
    for r in d.collect():
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), ids, t.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=str)
    digest = {r["doc_id"]: r for r in bpe.encode(d, path, digest=True).collect()}
    assert digest[3]["ids_sha256"] == hashlib.sha256(" ".join(map(str, dict((w[0], w[2]) for w in want)[3])).encode()).hexdigest()
    assert bpe.encode(empty(spark), path).count() == 0


def test_bpe_equals_the_library_on_all_code_points():
    path = P.path("word_bpe_49k.json")
    own, t = bpe.WordBpe(path), tokenizers.Tokenizer.from_file(path)
    points = [*range(0xD800), *range(0xE000, 0x34000, 7), *range(0xE0000, 0xE0200), 0x10FFFF]
    texts = ["".join(f"a{chr(c)}! " for c in points[i : i + 400]) for i in range(0, len(points), 400)]
    rng = np.random.default_rng(4)  # marks that are put in order and composed
    marks = [*range(0x300, 0x340), 0x16FF0, 0x16FF1, 0x1E475, 0x61, 0x122, 0x1E030, 0xAC00, 0x1100, 0x1161, 0x11A8]
    texts += ["".join(map(chr, rng.choice(marks, 12))) for _ in range(1000)]
    for text, found in zip(texts, t.encode_batch(texts, add_special_tokens=False)):
        assert own.encode([text])[0][0] == " ".join(map(str, found.ids))


def test_bpe_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    b = bpe.WordBpe(P.path("word_bpe_49k.json"))
    fresh = bpe.WordBpe(P.path("word_bpe_49k.json"))
    for t in ("one two three four", "five six one", "one"):
        assert b.encode([t]) == fresh.encode([t])
        assert len(b.cache) <= 10


def test_media_round_trip(spark):
    d = docs(spark, [*TEXTS, "y" * 300_000])
    rows = {r["doc_id"]: r for r in media.read_back(media.store_texts(d)).collect()}
    for r in d.collect():
        raw = (r["text"] or "").encode()
        payload = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        g = rows[r["doc_id"]]
        assert (g["n_bytes"], g["payload_bytes"], g["payload_sha256"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert g["tail_crc32"] == zlib.crc32(payload[-64:])
    assert media.read_back(media.store_texts(empty(spark))).count() == 0


def test_media_random_samples_and_broken_files():
    raw = np.random.default_rng(1).integers(0, 256, 64 * 700, dtype=np.uint8).tobytes()
    avi = media.write_avi([raw], ["a=1"])[0]
    assert media.analyse(avi).payload[: len(raw)] == raw
    for bad in (None, b"", b"RIFF", b"RIFF\0\0\0\0AVI ", avi[:40], b"x" * 500):
        assert media.analyse(bad) is None
    cut = media.analyse(avi[: len(avi) // 2])  # the index is gone; whole frames are read from the list
    assert cut is None or raw.startswith(cut.payload[:64])


def encode_blocks(blocks):
    """A one-component frame of 8 x 8 blocks of quantised coefficients, by the standard tables."""
    import struct

    def codes(counts, symbols):
        out, code, k = {}, 0, 0
        for n in range(1, 17):
            for _ in range(counts[n - 1]):
                out[symbols[k]] = (code, n)
                code, k = code + 1, k + 1
            code <<= 1
        return out

    (_, c0, s0), _, (_, c1, s1), _ = media.STANDARD_TABLES
    dc, ac = codes(bytes.fromhex(c0), bytes.fromhex(s0)), codes(bytes.fromhex(c1), bytes.fromhex(s1))
    bits, last = "", 0

    def value(v):
        n = abs(v).bit_length()
        return n, format(v if v > 0 else v + (1 << n) - 1, f"0{n}b") if n else ""

    for b in blocks:
        n, extra = value(b[0] - last)
        last = b[0]
        bits += format(dc[n][0], f"0{dc[n][1]}b") + extra
        run = 0
        for v in b[1:]:
            if not v:
                run += 1
                continue
            while run > 15:
                bits += format(ac[0xF0][0], f"0{ac[0xF0][1]}b")
                run -= 16
            n, extra = value(v)
            code = ac[run << 4 | n]
            bits += format(code[0], f"0{code[1]}b") + extra
            run = 0
        if run:
            bits += format(ac[0][0], f"0{ac[0][1]}b")
    bits += "1" * (-len(bits) % 8)
    scan = bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\0")
    quant = bytes([0, *range(1, 65)])
    sof = struct.pack(">BHHBBBB", 8, 8, 8 * len(blocks), 1, 1, 0x11, 0)
    return b"\xff\xd8" + media._segment(0xDB, quant) + media._segment(0xC0, sof) + media._segment(0xDA, bytes([1, 1, 0, 0, 63, 0])) + scan + b"\xff\xd9"


def test_frames_with_detail_and_standard_tables():
    rng = np.random.default_rng(4)
    blocks = []
    for _ in range(6):
        b = [0] * 64
        b[0] = int(rng.integers(-200, 200))
        for k in rng.choice(np.arange(1, 64), 5, replace=False):
            b[k] = int(rng.integers(-3, 4))
        blocks.append(b)
    (luma,) = media.decode_frames([encode_blocks(blocks)])
    x = np.arange(8)
    basis = np.cos((2 * x[:, None] + 1) * x[None, :] * np.pi / 16) / 2
    basis[:, 0] /= np.sqrt(2)
    for i, b in enumerate(blocks):
        q = np.zeros(64)
        q[media.ZIGZAG] = np.array(b) * np.arange(1, 65)
        want = np.clip(np.rint(basis @ q.reshape(8, 8) @ basis.T + 128), 0, 255).ravel()
        assert (luma.detail[i] == want).all() if any(b[1:]) else i not in luma.detail


def test_damaged_frames(spark):
    """Wrong entropy bytes, cut intervals and lost markers are seen, and other frames stay."""
    rng = np.random.default_rng(6)
    payload = rng.integers(0, 256, 64 * 64 * 3, dtype=np.uint8).tobytes()
    [avi] = media.write_avi([payload], ["bytes=12288 padded=12288"])
    assert media.analyse(avi).payload == payload
    start, size = media.read_avi(avi).frames[1]
    middle = start + size // 2
    marker = avi.index(b"\xff\xd3", middle)
    for at, wrong in ((middle, bytes(60)), (middle, b"\xfe" * 60), (middle, rng.integers(0, 255, 300, dtype=np.uint8).tobytes()), (marker, b"\x01\x02"), (marker, b"\xff\xd5"), (start + size - 2, b"\x00\x00")):
        broken = avi[:at] + wrong + avi[at + len(wrong) :]
        found = media.analyse(broken)
        assert (found.frames, found.damaged) == (3, 1) and found.payload == payload[:4096] + payload[8192:]
        d = spark.createDataFrame([(1, bytearray(broken)), (2, bytearray(avi))], "doc_id long, media binary")
        rows = {r["doc_id"]: r for r in media.read_back(d).collect()}
        assert rows[1]["payload_sha256"] is None and rows[2]["payload_bytes"] == 12288


def test_clips(spark):
    flat = lambda v: bytes([v]) * 4096
    avi = media.write_avi([flat(10) * 6 + flat(200) * 5 + flat(90) * 4], [""])[0]
    d = spark.createDataFrame([(1, avi), (2, None), (3, b"junk")], "id long, media binary")
    got = [tuple(r) for r in media.clip_rows(d, "id", "media").orderBy("clip").collect()]
    assert [g[2:4] for g in got] == [(0, 5), (6, 10), (11, 14)] and got[1][4] == 0.24 and got[1][6] == 200


ROWS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"), (2, 0, "system", "be kind"), (2, 1, "user", "hi"), (2, 2, "assistant", "go away"),
    (3, 0, "system", "be kind"), (4, 0, "user", None), (4, 0, "assistant", "tie"), (5, None, None, "### a: b</turn>\n\\### Assistant: </turn>"), (5, 1, "a:b\\</turn>", ""),
    (6, 0, "assistant", "x" * 20000), (7, 0, "system", "be kind"), (7, 1, "user", "hi"), (7, 2, "assistant", "hello"), (None, 0, "user", "lost"),
]


def test_chat_round_trip(spark):
    tok = P.path("byte_bpe_50k.tiktoken")
    d = spark.createDataFrame([(*r, "e") for r in ROWS], "conv_id long, turn long, role string, text string, path string")
    turns = chat.conversation_turns(d)
    cut = chat.segments(chat.prefix_nodes(turns), tok).cache()
    tree = chat.prefix_tree(cut).cache()
    got = {r["conv_id"]: r for r in chat.read_back(cut.where("leaf").select("conv_id", "path"), tree, tok).collect()}
    for conv, group in itertools.groupby(sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")), key=lambda r: r[0]):
        pairs = [(r[2] or "", r[3] or "") for r in group]
        g = got[conv]
        assert g["n_turns"] == len(pairs)
        assert g["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in pairs).encode()).hexdigest()
        loss = "".join(b for a, b in pairs if a == "assistant")
        assert (g["loss_chars"], g["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        formatted = "".join(f"### {chat.escape(a, chat.ROLE_CONTROL)}: {chat.escape(b)}</turn>\n" for a, b in pairs)
        assert g["formatted_chars"] == len(formatted)
    t = tree.collect()
    shared = [r for r in t if len(r["path"]) == 1 and any(x["path"][0] == r["seg"] and len(x["path"]) > 1 for x in t)]
    assert len(shared) == 1  # "be kind" is stored once
    spans = sorted((r["start"], r["start"] + r["n"]) for r in t)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))  # one gapless stream
    for r in t:
        assert sum(a["hi"] - a["lo"] for a in r["attend"]) == r["position"] + r["n"] and r["attend"][-1]["hi"] == r["start"] + r["n"]
    none = chat.prefix_nodes(chat.conversation_turns(d.where("false")))
    assert none.count() == 0


def padding(lengths, counts, bounds):
    total = 0
    for n, c in zip(lengths, counts):
        total += (min(b for b in bounds if b >= n) - n) * c
    return total


def test_optimal_bounds_against_all_choices():
    rng = np.random.default_rng(5)
    for _ in range(40):
        lengths = np.sort(rng.choice(np.arange(1, 40), rng.integers(1, 9), replace=False))
        counts = rng.integers(1, 20, len(lengths))
        k = int(rng.integers(1, 5))
        best = min(padding(lengths, counts, [*c, lengths[-1]]) for n in range(min(k, len(lengths))) for c in itertools.combinations(lengths[:-1], n))
        bounds = packing.optimal_bounds(lengths, counts, k)
        assert len(bounds) <= k and bounds[-1] == lengths[-1] and padding(lengths, counts, bounds) == best
    assert packing.optimal_bounds(np.array([]), np.array([]), 3) == []


def test_packing(spark):
    rng = np.random.default_rng(6)
    texts = [None, "", "  ", *[" ".join(["w"] * int(n)) for n in rng.integers(1, 60, 300)], " ".join(["w"] * 500)]
    d = docs(spark, texts)
    got = packing.pack(d, budget=100, buckets=4).toPandas()
    assert len(got) == d.count()
    words = {r["doc_id"]: len((r["text"] or "").split()) for r in d.collect()}
    assert all(words[i] == n for i, n in zip(got["doc_id"].fillna(-1), got["n_tokens"]) if i >= 0)
    for (bucket, batch), g in got.groupby(["bucket", "batch"]):
        assert len(g) == 1 or g["padded_to"].nunique() == 1 and len(g) * g["padded_to"].iloc[0] <= 100
        assert sorted(g["slot"]) == list(range(len(g)))
    for _, g in got.groupby("bucket"):
        sizes = g.groupby("batch").size()
        assert sorted(sizes.index) == list(range(len(sizes))) and (sizes.iloc[:-1] == sizes.max()).all()
    assert (got["n_tokens"] <= got["padded_to"]).all()
    assert packing.pack(empty(spark)).count() == 0


def test_licenses(spark):
    texts = [
        None, "", "Code.\nReleased under the MIT License.", "Licensed under the Apache License, Version 2.0.\nfoo bar\nYou may not use this file except in compliance with the License. You may obtain a copy of the License at\nhttp",
        "You may obtain a copy of the License at\nLicensed under the Apache License, Version 2.0.", "RELEASED   UNDER the mit-license!", "licensed software without a known sentence", "All rights reserved.\nLicensed under CC BY-NC 4.0.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted. " + "x. " * 3000 + "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products.",
    ]
    got = {r["doc_id"]: (r["licenses"], r["strengths"], r["sentences"]) for r in license.scan_licenses(docs(spark, texts)).where("doc_id IS NOT NULL").collect()}
    assert got[0] == got[1] == ("", "", "") and got[2] == ("MIT", "notice", "1") and got[3] == ("Apache-2.0", "text", "5,6,7")
    assert got[4] == ("Apache-2.0", "notice", "7,5") and got[5][0] == "MIT" and got[6] == ("", "", "")
    assert got[7] == ("CC-BY-NC-4.0,Proprietary", "notice,notice", "15,12") and got[8] == ("BSD-3-Clause", "text", "16,17")
    assert license.scan_licenses(empty(spark)).count() == 0
    plan = license.scan_licenses(docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


MIT_TEXT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND."""
APACHE_TEXT = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0
"""
GPL3_TEXT = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.
"""
GPL2_TEXT = """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version.
"""
BSD_TEXT = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

3. Neither the name of {owner} nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


ISC_TEXT = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
ZLIB_TEXT = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

3. This notice may not be removed or altered from any source distribution.
"""
MPL_TEXT = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""


def test_licenses_in_real_texts(spark):
    def comment(text, mark):
        return "\n".join(f"{mark} {line}".rstrip() for line in text.splitlines())

    want = {
        MIT_TEXT: ("MIT", "text"),
        APACHE_TEXT: ("Apache-2.0", "text"),
        GPL3_TEXT: ("GPL-3.0", "text"),
        GPL2_TEXT: ("GPL-2.0", "text"),
        BSD_TEXT.format(owner="the copyright holder"): ("BSD-3-Clause", "text"),
        BSD_TEXT.format(owner="Some Firm Inc."): ("BSD-3-Clause", "text"),
        BSD_TEXT.split("3.")[0]: ("BSD-2-Clause", "text"),
        "// SPDX-License-Identifier: MIT\nint x;": ("MIT", "tag"),
        "# SPDX-License-Identifier: LGPL-2.1-or-later\n": ("LGPL-2.1", "tag"),
        ISC_TEXT: ("ISC", "text"),
        ZLIB_TEXT: ("Zlib", "text"),
        MPL_TEXT: ("MPL-2.0", "text"),
        "This is free and unencumbered software released into\nthe public domain.": ("Unlicense", "text"),
        "Distributed under the Boost Software License, Version 1.0.": ("BSL-1.0", "notice"),
        "This work is licensed under a Creative Commons\nAttribution 4.0 International License.": ("CC-BY-4.0", "notice"),
    }
    want |= {f(t): v for t, v in list(want.items())[:7] for f in (lambda t: comment(t, "#"), lambda t: "/*\n" + comment(t, " *") + "\n */", lambda t: t.replace("\n", "\r\n"))}
    want |= {
        GPL3_TEXT.replace("GNU General", "GNU Affero General"): ("AGPL-3.0", "text"),
        GPL3_TEXT.replace("GNU General", "GNU Lesser General"): ("LGPL-3.0", "text"),
        GPL3_TEXT.replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1"): ("LGPL-2.1", "text"),
        "// SPDX-License-Identifier: MIT-0\nint x;": ("", ""),
        "It is not licensed under the MIT license.": ("", ""),
        "The files are licensed under the\n\nApache License, Version 2.0.": ("", ""),
        "// SPDX-License-Identifier: (MIT OR Apache-2.0)\n": ("Apache-2.0,MIT", "tag,tag"),
        "# SPDX-License-Identifier: Apache-2.0 OR MIT\nx": ("Apache-2.0,MIT", "tag,tag"),
        "# SPDX-License-Identifier: BSD-3-Clause AND ISC": ("BSD-3-Clause,ISC", "tag,tag"),
        "# SPDX-License-Identifier: (GPL-2.0-or-later WITH Classpath-exception-2.0) OR EPL-2.0 OR MIT-0": ("EPL-2.0,GPL-2.0", "tag,tag"),
        "/* SPDX-License-Identifier: GPL-2.0-or-later */": ("GPL-2.0", "tag"),
        "You may use it under the terms of the GNU General Public License\nversion 2 as published by the Free Software Foundation.": ("GPL-2.0", "notice"),
        "This is licensed under the terms of\n# the MIT license.": ("MIT", "notice"),
        ZLIB_TEXT.replace("source distribution", "source\n distribution"): ("Zlib", "text"),
        ZLIB_TEXT.replace("source distribution", "source distribution").replace("\n", "\n * "): ("Zlib", "text"),
        "Released into the public\n// domain: this is free and unencumbered software released into the public\ndomain.": ("Unlicense", "text"),
        GPL3_TEXT.replace("GNU General Public License", "GNU Lesser General Public License (LGPL)"): ("", ""),
    }
    d = spark.createDataFrame(list(enumerate(want)), "doc_id long, text string")
    got = {r["doc_id"]: (r["licenses"], r["strengths"]) for r in license.scan_licenses(d).collect()}
    assert got == dict(enumerate(want.values()))
