"""Licence scans by sentence rules: known licence sentences, found as word sequences inside a
text's normalised sentences, become identifiers, and the identifiers in a document's order are
matched against ordered rules. Sentences run on over line breaks and comment marks.
DataFrame functions only; every row is judged in place, without a shuffle."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.core.io import table

#: Licence sentences as the licences or their usual notices word them, with identifiers.
SENTENCES = {
    "released under the mit license": 1,
    "licensed under the mit license": 2,
    "permission is hereby granted free of charge to any person obtaining a copy of this software": 3,
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": 4,
    "licensed under the apache license version 2 0": 5,
    "you may not use this file except in compliance with the license": 6,
    "you may obtain a copy of the license at": 7,
    "this work is licensed under the gnu general public license version 3": 8,
    "this program is free software": 9,
    "either version 3 of the license or at your option any later version": 10,
    "either version 2 of the license or at your option any later version": 11,
    "licensed under cc by nc 4 0": 12,
    "licensed under cc by 4 0": 13,
    "licensed under cc by sa 4 0": 14,
    "all rights reserved": 15,
    "redistribution and use in source and binary forms with or without modification are permitted": 16,
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products": 17,
    "this work is dedicated to the public domain": 18,
    "spdx license identifier mit": 19,
    "spdx license identifier apache 2 0": 20,
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": 21,
    "this software is provided as is without any express or implied warranty": 22,
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely": 23,
    "this notice may not be removed or altered from any source distribution": 24,
    "this is free and unencumbered software released into the public domain": 25,
    "this source code form is subject to the terms of the mozilla public license v": 26,
    "if a copy of the mpl was not distributed with this file you can obtain one at": 27,
    "gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": 28,
    "gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": 29,
    "gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": 30,
    "distributed under the boost software license version 1 0": 31,
    "this program and the accompanying materials are made available under the terms of the eclipse public license v": 32,
    "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed": 33,
    "licensed under cc by nd 4 0": 34,
    "licensed under cc by nc sa 4 0": 35,
    "licensed under cc by nc nd 4 0": 36,
    "all advertising materials mentioning features or use of this software must display the following acknowledgement": 37,
    "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license": 38,
    "use of this source code is governed by a bsd style license": 39,
    "subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license": 40,
    "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law": 41,
    "the gnu general public license is a free copyleft license for software and other kinds of works": 42,
    "permission is hereby granted free of charge to any person obtaining a copy of the font software": 43,
    "this font software is licensed under the sil open font license version 1 1": 44,
    "licensed under the universal permissive license v": 45,
    "licensed under the european union public licence": 46,
    "you may use distribute and copy it under the terms of the artistic license 2 0": 47,
    "under the terms of the gnu general public license version 2 as published by the free software foundation": 48,
    "under the terms of the gnu general public license version 3 as published by the free software foundation": 49,
}
#: Names of SPDX tags beyond those above (fixed values): a tag is a sentence of its own.
TAGS = ["0BSD", "AGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "EPL-2.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "OFL-1.1", "UPL-1.0", "Unlicense", "Zlib"]
SENTENCES |= {f"spdx license identifier {re.sub('[^a-z0-9]+', ' ', tag.lower())}": 101 + i for i, tag in enumerate(TAGS)}
#: Ordered rules (fixed values): a document has the licence if the identifiers occur in this order;
#: other sentences may lie between. The first rule of a licence that matches names its strength.
RULES = [
    ("MIT", "text", [3, 4]),
    ("MIT", "notice", [1]),
    ("MIT", "notice", [2]),
    ("MIT", "tag", [19]),
    ("Apache-2.0", "text", [5, 6, 7]),
    ("Apache-2.0", "notice", [5]),
    ("Apache-2.0", "tag", [20]),
    ("GPL-3.0", "text", [9, 10]),
    ("GPL-3.0", "notice", [8]),
    ("GPL-2.0", "text", [9, 11]),
    ("GPL-2.0", "notice", [48]),
    ("GPL-3.0", "notice", [49]),
    ("CC-BY-NC-4.0", "notice", [12]),
    ("CC-BY-4.0", "notice", [13]),
    ("CC-BY-SA-4.0", "notice", [14]),
    ("BSD-3-Clause", "text", [16, 17]),
    ("BSD-2-Clause", "text", [16]),
    ("CC0-1.0", "notice", [18]),
    ("Proprietary", "notice", [15]),
    ("ISC", "text", [21]),
    ("Zlib", "text", [22, 23, 24]),
    ("Unlicense", "text", [25]),
    ("MPL-2.0", "text", [26, 27]),
    ("MPL-2.0", "notice", [26]),
    ("LGPL-2.1", "text", [28]),
    ("LGPL-3.0", "text", [29]),
    ("AGPL-3.0", "text", [30]),
    ("BSL-1.0", "notice", [31]),
    ("EPL-2.0", "notice", [32]),
    ("WTFPL", "text", [33]),
    ("CC-BY-ND-4.0", "notice", [34]),
    ("CC-BY-NC-SA-4.0", "notice", [35]),
    ("CC-BY-NC-ND-4.0", "notice", [36]),
    ("BSD-4-Clause", "text", [16, 37]),
    ("GFDL", "notice", [38]),
    ("BSD-style", "notice", [39]),
    ("Apache-2.0", "text", [40]),
    ("CC0-1.0", "text", [41]),
    ("GPL-3.0", "text", [42]),
    ("OFL-1.1", "text", [44, 43]),
    ("OFL-1.1", "notice", [44]),
    ("UPL-1.0", "notice", [45]),
    ("EUPL", "notice", [46]),
    ("Artistic-2.0", "notice", [47]),
    *[(tag, "tag", [101 + i]) for i, tag in enumerate(TAGS)],
]
#: A licence's rule that holds a lesser licence's sentences hides it (fixed values).
HIDES = [("BSD-3-Clause", "BSD-2-Clause"), ("BSD-4-Clause", "BSD-3-Clause"), ("BSD-4-Clause", "BSD-2-Clause")]
#: Further wordings in real licence texts and notices (fixed values), with the same identifiers.
WORDINGS = {
    "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software": 4,
    "licensed under the apache license 2 0": 5,
    "nor the names of its contributors may be used to endorse or promote products derived from this software": 17,
    "licensed under a creative commons attribution noncommercial 4 0 international license": 12,
    "licensed under a creative commons attribution 4 0 international license": 13,
    "licensed under a creative commons attribution sharealike 4 0 international license": 14,
    "licensed under a creative commons attribution noderivatives 4 0 international license": 34,
    "licensed under a creative commons attribution noncommercial sharealike 4 0 international license": 35,
    "licensed under a creative commons attribution noncommercial noderivatives 4 0 international license": 36,
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted": 21,
    "this software is provided as is without any express or implied warranties": 22,
    "gnu library general public license as published by the free software foundation either version 2 of the license or at your option any later version": 28,
    "under the terms of the eclipse public license 2 0": 32,
    "governed by a bsd style license": 39,
    "licensed under the terms of the mit license": 2,
    "released under the terms of the mit license": 1,
    "under the terms of version 2 of the gnu general public license as published by the free software foundation": 48,
    "under the terms of version 3 of the gnu general public license as published by the free software foundation": 49,
}
#: A line with a tag is a paragraph of its own.
TAG = r"(?im)^(.*SPDX-License-Identifier:.*)$"
#: Bounds of sentences: lines without letters and digits (blank, or comment marks alone), and
#: stops and marks before white space or the end.
BOUND = r"\n[^\p{L}\p{N}\n]*(?=\n)|[.!?]+[\"')\]]*(?:[ \t\n\f]+|$)"
#: The GPL's notice after another licence's name is not the GPL's.
OTHER = r"(?<!(?:lesser|library|affero) general public license.{0,400} either version)"
#: A tag's further names stand behind these words, each as in a tag of its own.
NEXT_NAME = r" (?:or|and) (?!later\b)"
#: What every known sentence holds; texts without it have no known sentence.
NEEDED = "licen[sc]|permi|copyright|software|version|reserved|redistribution|dedicated|public[^a-z0-9]+domain|source[^a-z0-9]+distribution|mpl|acknowledgement"


def normalised(sentence):
    """Lower case, runs of other than a-z and 0-9 as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def sentence_ids(text):
    """Identifiers of the known licence sentences of a text column, in order of occurrence."""
    phrases = SENTENCES | WORDINGS
    known = F.create_map(*[F.lit(x) for pair in phrases.items() for x in pair])
    # Longest first; not after "not", and "MIT" not before the rest of another tag's name.
    any_of = "|".join(sorted(phrases, key=len, reverse=True)).replace("identifier mit", "identifier mit(?! (?:0|cmu|modern|advertising|enna|feh|festival|khronos|click|open|wu|stk|testregex)\\b)")
    any_of = any_of.replace("|either version", f"|either version{OTHER}")
    pattern = rf"(?<!\bnot )\b({any_of})\b"
    tag = "spdx license identifier"
    each_name = lambda s: F.when(s.contains(tag), F.regexp_replace(s, NEXT_NAME, f" {tag} ")).otherwise(s)
    lines = F.regexp_replace(F.regexp_replace(text, "\\r\\n?", "\n"), TAG, "\n\n$1\n\n")
    lines = F.regexp_replace(lines, r"(?im)^[ \t]*(?:dnl|rem)\b", "")
    hits = F.filter(F.split(lines, BOUND), lambda s: F.lower(s).rlike(NEEDED))
    clean = F.transform(hits, lambda s: each_name(normalised(s)))
    found = F.flatten(F.transform(clean, lambda s: F.regexp_extract_all(s, F.lit(pattern), F.lit(1))))
    return F.transform(found, lambda p: F.try_element_at(known, p))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, licenses, strengths, sentences): one row a document.

    ``sentences``: identifiers joined by commas, ``licenses``: names of the licences whose rule
    matches, by name, with the strength of the first matching rule; all empty where there is
    none. Names stand for a licence's version, with or without later ones. A tag with several
    names (AND, OR) gives them all, one with an exception (WITH) the licence. Null and empty
    texts have none. Null ids and repeated rows pass through.
    """
    d = docs.select(F.col(id_col).alias(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ids = F.when(F.lower("text").rlike(NEEDED), F.array_join(sentence_ids(F.col("text")), ",")).otherwise(F.lit(""))
    d = d.select(id_col, ids.alias("sentences"))
    in_order = lambda rule: F.concat(F.lit(","), F.col("sentences"), F.lit(",")).rlike("," + ",(?:.*,)?".join(map(str, rule)) + ",")
    by_name: dict[str, list] = {}
    for name, strength, rule in RULES:
        by_name.setdefault(name, []).append((strength, in_order(rule)))
    found = []
    for name in sorted(by_name):
        case = F.lit(None).cast("string")
        for strength, test in reversed(by_name[name]):
            case = F.when(test, F.lit(strength)).otherwise(case)
        found.append(F.struct(F.lit(name).alias("name"), case.alias("strength")))
    hits = F.filter(F.array(*found), lambda x: x["strength"].isNotNull())
    names = F.transform(hits, lambda x: x["name"])
    for greater, lesser in HIDES:
        hits = F.filter(hits, lambda x: ~(F.array_contains(names, greater) & (x["name"] == lesser)))  # noqa: B023
    hits = F.when(F.col("sentences") != "", hits).otherwise(F.array().cast("array<struct<name:string,strength:string>>"))
    d = d.withColumn("hits", hits)
    return d.select(
        id_col,
        F.array_join(F.transform("hits", lambda x: x["name"]), ",").alias("licenses"),
        F.array_join(F.transform("hits", lambda x: x["strength"]), ",").alias("strengths"),
        "sentences",
    )


def op8_license_rules(spark, sf_dir: str) -> DataFrame:
    """Every document's licence sentences and licences."""
    return scan_licenses(table(spark, sf_dir, "documents"))


def _sql() -> str:
    known = ", ".join(f"('{s}', {i})" for s, i in SENTENCES.items())
    rules = ", ".join(f"({r}, '{n}', '{s}', '{',' + ',(?:.*,)?'.join(map(str, ids)) + ','}')" for r, (n, s, ids) in enumerate(RULES))
    hides = ", ".join(map(str, HIDES))
    return rf"""
WITH known(sentence, id) AS (VALUES {known}),
rules(r, name, strength, pattern) AS (VALUES {rules}),
hides(greater, lesser) AS (VALUES {hides}),
cut AS (
  SELECT doc_id, string_split_regex(coalesce(text, ''), '[\n\r]+|[.!?;]+(?:[ \t\n\f\r]+|$)') AS s FROM documents
), parts AS (
  SELECT doc_id, unnest(s) AS s, generate_subscripts(s, 1) AS at FROM cut
), ids AS (
  SELECT p.doc_id, string_agg(CAST(k.id AS VARCHAR), ',' ORDER BY p.at) AS sentences
  FROM parts p JOIN known k ON trim(regexp_replace(lower(p.s), '[^a-z0-9]+', ' ', 'g')) = k.sentence
  GROUP BY p.doc_id
), hits AS (
  SELECT i.doc_id, r.name, arg_min(r.strength, r.r) AS strength
  FROM ids i JOIN rules r ON regexp_matches(',' || i.sentences || ',', r.pattern) GROUP BY i.doc_id, r.name
), kept AS (
  SELECT h.* FROM hits h WHERE NOT EXISTS (SELECT 1 FROM hits b JOIN hides x ON b.name = x.greater WHERE b.doc_id = h.doc_id AND h.name = x.lesser)
), whole AS (
  SELECT doc_id, string_agg(name, ',' ORDER BY name) AS licenses, string_agg(strength, ',' ORDER BY name) AS strengths FROM kept GROUP BY doc_id
)
SELECT d.doc_id, coalesce(w.licenses, '') AS licenses, coalesce(w.strengths, '') AS strengths, coalesce(i.sentences, '') AS sentences
FROM documents d LEFT JOIN ids i USING (doc_id) LEFT JOIN whole w USING (doc_id)
"""


OP8_SQL = _sql()
