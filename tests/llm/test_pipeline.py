"""The corpus pipeline stage by stage and as a whole, on the smallest data folder."""

import collections
import os
import re

import numpy as np
import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no data folder")


def test_null_and_repeated_ids_stay(spark):
    import corpus_pipeline as p
    from pyspark.sql import functions as F
    from tarnworks.core.io import table

    docs = table(spark, SF, "documents").limit(60)
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, None).otherwise(F.col("doc_id"))).cache()
    rows = docs.collect()
    known = next(r for r in rows if r["doc_id"] is not None)
    odd = spark.createDataFrame([known[:1] + ("0123 4567 89",) + known[2:]], docs.schema)
    first = p.language_id(spark, docs.unionByName(odd), SF).cache()
    assert sorted(r["text"] for r in first.collect()) == sorted(r["text"] for r in rows)
    kept = p.near_duplicates(spark, first, SF)
    assert kept.where("doc_id IS NULL").count() == sum(r["doc_id"] is None for r in rows) > 0


def test_stages(spark):
    import corpus_pipeline as p
    from tarnworks.core.io import table

    docs = table(spark, SF, "documents").cache()
    odd = spark.createDataFrame([(10**9, None, "en", "src0", 0), (10**9 + 1, "", None, None, 0)], docs.schema)
    first = p.language_id(spark, docs.unionByName(odd), SF).cache()
    assert first.columns == docs.columns and first.count() == docs.count()
    kept = p.near_duplicates(spark, first, SF).cache()
    assert kept.columns == docs.columns and 0 < kept.count() < first.count() and kept.select("text").distinct().count() == kept.count()
    clean = p.secrets(spark, kept, SF).cache()
    assert clean.columns == docs.columns and clean.count() == kept.count()
    changed = clean.join(kept.select("doc_id", kept["text"].alias("was")), "doc_id").where("text <> was")
    assert changed.where("text NOT LIKE '%[SECRET]%'").count() == 0
    assert clean.where("text RLIKE 'token = \"[0-9a-f]{40}\"|AKIA[0-9A-Z]{16}'").count() == 0
    assert p.pack(spark, clean, SF).count() == clean.count()
    assert p.run(spark, SF).count() == p.pack(spark, p.secrets(spark, p.near_duplicates(spark, p.language_id(spark, docs, SF), SF), SF), SF).count()


def plain_least_padding(counts, buckets):
    """Least padding of at most ``buckets`` buckets over {length: documents}, every cut tried."""
    lengths = sorted(counts)
    best = {0: 0}  # lengths covered so far: padding
    for _ in range(buckets):
        new = dict(best)
        for i, cost in best.items():
            for j in range(i + 1, len(lengths) + 1):
                cost += (lengths[j - 1] - lengths[j - 2] if j - 2 >= i else 0) * sum(counts[x] for x in lengths[i : j - 1])
                new[j] = min(new.get(j, cost), cost)
        best = new
    return best[len(lengths)]


def walked(tree, x):
    at = 0
    while tree["feature"][at] >= 0:
        at = tree["left"][at] if x[tree["feature"][at]] <= tree["split"][at] else tree["right"][at]
    return float(tree["share"][at])


def test_run_against_brute_force(spark, tmp_path, monkeypatch):
    """run() over the whole table, with odd rows, against plain loops over all rows: posteriors from
    all other rows, all pairs of shingle sets, each finding through each tree, every bucket cut."""
    import corpus_pipeline as p
    from tarnworks.core.io import table
    from tarnworks.llm import langid, packing, secretscan
    from test_search_ops import brute_components, plain_buckets, plain_posterior

    base = table(spark, SF, "documents")
    some = base.where("text IS NOT NULL AND n_chars < 3000").orderBy("doc_id").limit(3).collect()
    key = "key = AKIA" + "ABCDEFGHJKLMNPQR"
    odd = [(10**9, None, "en", "src0", 0), (10**9 + 1, "", None, None, 0), (10**9 + 2, "0123 4567", "en", "src0", 9), some[0], (None, some[1]["text"], some[1]["lang"], some[1]["source"], some[1]["n_chars"])]
    odd += [(10**9 + 3, re.sub("[a-z]", lambda m: m[0].upper(), some[2]["text"]), some[2]["lang"], "new", some[2]["n_chars"]), (10**9 + 4, f"{some[1]['text'][::2]} {key} {some[1]['text']}", some[1]["lang"], "new", 1)]
    rng = np.random.default_rng(3)
    tokens = {}
    for i, r in enumerate(base.where("length(text) BETWEEN 300 AND 4000").orderBy("doc_id").limit(60).collect()):
        hidden = "".join(rng.choice(list("0123456789abcdef"), 40))  # every second word: no near copy
        given = "build_token_v2(request)" if i % 3 == 2 else f'"{hidden}"'
        tokens[2 * 10**9 + i] = None if i % 3 == 2 else hidden
        half = r["text"].split()[::2]
        at = int(rng.integers(len(half)))
        odd.append((2 * 10**9 + i, " ".join([*half[:at], "token =", given, *half[at:]]), r["lang"], r["source"], 1))
    docs = base.unionByName(spark.createDataFrame(odd, base.schema))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = table(spark, SF, "labels")
    told = spark.createDataFrame([(i, 1, 0) for i in tokens if i < 2 * 10**9 + 45], "doc_id long, quality int, toxic int")
    labels.select("doc_id", "quality", "toxic").unionByName(told.select(*[told[f.name].cast(f.dataType) for f in labels.schema if f.name in told.columns])).write.parquet(f"{tmp_path}/labels.parquet")
    docs = table(spark, str(tmp_path), "documents")

    fits, seen, fitted, pack = [], [], secretscan.fitted, packing.pack
    monkeypatch.setattr(secretscan, "fitted", lambda *a, **k: fits.append(fitted(*a, **k)) or fits[-1])
    monkeypatch.setattr(packing, "pack", lambda d: seen.append(d) or pack(d))
    got = p.run(spark, str(tmp_path)).collect()

    rows = docs.collect()
    host = lambda s: None if s is None else f"source:{s}"
    plain = [(plain_buckets(r["text"]) if r["text"] else [], r["lang"] and r["lang"].lower(), None, host(r["source"]), host(r["source"])) for r in rows]
    judged = list(zip(rows, plain_posterior(plain, *langid.fit_text_model(docs))))
    assert all(abs(x - 0.5) > 1e-4 for _, (_, x) in judged)
    stay = [(r, name) for r, (name, x) in judged if name != "und" and x >= 0.5]
    assert {10**9, 10**9 + 1, 10**9 + 2}.isdisjoint(r["doc_id"] for r, _ in stay)
    groups = brute_components({r["doc_id"]: r["text"] for r, _ in stay if r["doc_id"] is not None}, 5, 80)
    stay = [(r, name) for r, name in stay if r["doc_id"] is None or groups[r["doc_id"]][2]]
    assert sum(r["doc_id"] == some[0]["doc_id"] for r, _ in stay) == 2 and 10**9 + 3 not in [r["doc_id"] for r, _ in stay]

    (dictionary, forest), want = fits[0], []
    for r, name in stay:
        text = r["text"]
        for a, b, _ in sorted(secretscan.spans(text), reverse=True):
            x = secretscan.features(text, a, b, r["source"] or "", dictionary)
            if secretscan.ISSUED.match(text[a:b]) or np.mean([walked(t, x) for t in forest]) >= 0.5:
                text = f"{text[:a]}[SECRET]{text[b:]}"
        want.append((r["doc_id"], text, name, r["source"], len(text)))
    order = lambda rows: sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert order(seen[0].collect()) == order(want)
    ends = {r[0]: r[1] for r in want}
    assert key not in ends[10**9 + 4] and "[SECRET]" in ends[10**9 + 4] and len(ends.keys() & tokens.keys()) > 40
    for i in ends.keys() & tokens.keys():  # the last fifteen have no labels
        assert tokens[i] not in ends[i] if tokens[i] else "build_token_v2(request)" in ends[i]

    words = collections.Counter((i, len([w for w in re.split(r"[ \t\n\x0b\f\r]+", text) if w])) for i, text, *_ in want)
    assert collections.Counter((r["doc_id"], r["n_tokens"]) for r in got) == words
    sizes = collections.Counter(max(1, r["n_tokens"]) for r in got)
    assert sum(r["padded_to"] - max(1, r["n_tokens"]) for r in got) == plain_least_padding(sizes, packing.BUCKETS)
    batches = collections.defaultdict(list)
    for r in got:
        batches[r["bucket"], r["padded_to"], r["batch"]].append(r["slot"])
    for (bucket, bound, batch), slots in batches.items():
        room = max(1, packing.TOKEN_BUDGET // bound)
        assert sorted(slots) == list(range(len(slots))) and (len(slots) == room or (bucket, bound, batch + 1) not in batches)


def test_empty_documents(spark, tmp_path):
    import corpus_pipeline as p
    from tarnworks.core.io import table

    table(spark, SF, "documents").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, SF, "labels").write.parquet(f"{tmp_path}/labels.parquet")
    assert p.run(spark, str(tmp_path)).collect() == []
