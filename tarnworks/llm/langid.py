"""Language ID by Bayesian evidence fusion.

Text likelihoods come from hashed letter trigrams; a declared language, the address
suffix and the host add evidence. Host priors are smoothed level by level: all rows ->
suffix -> domain -> host, each from counts by grouped aggregation over all rows, less the
row's own count.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.core.io import materialize, table

#: Hashed trigrams of the text model, so its table is 65,536 x languages at any corpus size.
BITS = 16
#: Labelled documents that fit the text model at most.
FIT_DOCS = 8_000
#: Share of the fitted rows that a language needs: at most 200 languages, so a table of 52 MB at most.
LEAST_SHARE = 0.005
#: Weight of a trigram's log likelihood: overlapping trigrams are not independent.
TEMPER = 0.25
#: Rows that a level's prior is worth beside its own counts.
STRENGTH = 5.0
PIECE = 1_000_000
_LETTER = np.zeros(256, np.uint32)
_LETTER[128:] = np.arange(128, 256)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)


def trigram_buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams over all texts and each text's bounds; what is no letter counts as one
    space, a text ends with two, and trigrams of spaces alone are left out."""
    raw = _LETTER[np.frombuffer(b"  ".join([*texts, b""]), np.uint8)]
    ends = np.cumsum([len(t) + 2 for t in texts])
    final = np.zeros(len(raw), bool)
    final[ends - 1] = final[ends - 2] = True
    keep = (raw > 0) | final
    keep[1:] |= raw[:-1] > 0
    raw, final, ends = raw[keep], final[keep], np.cumsum(keep)[ends - 1]
    code = raw[:-2] | raw[1:-1] << 8 | raw[2:] << 16
    own = (code > 0) & ~final[:-2]
    at = np.concatenate(([0], np.cumsum(own), np.full(2, own.sum())))[np.concatenate(([0], ends))]
    return (code[own] * np.uint32(2654435761)) >> np.uint32(32 - BITS), at


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    at, some, size = 0, [], 0
    texts = batch.column("text")
    for i, t in enumerate(texts):
        some.append((t.as_py() or "").encode("utf-8", "surrogatepass"))
        size += len(some[-1])
        if size > PIECE:
            yield batch.slice(at, len(some)), some
            at, some, size = i + 1, [], 0
    if some:
        yield batch.slice(at, len(some)), some


def fit_text_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fit_docs: int = FIT_DOCS, least_share: float = LEAST_SHARE) -> tuple[list[str], np.ndarray]:
    """Languages and log likelihoods (buckets x languages) from at most ``fit_docs`` labelled rows,
    those whose ids' digests are smallest. Rows with a null id, text or language are not labelled;
    a language of fewer than ``least_share`` of the fitted rows is none."""
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()
    chosen = named.select("id").orderBy(F.xxhash64("id"), "id").limit(fit_docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _pieces(batch):
                code, at = trigram_buckets(texts)
                lang = np.array(part.column("lang").to_pylist(), object)
                for name in sorted(set(lang)):
                    mine = np.concatenate([code[at[i] : at[i + 1]] for i in np.flatnonzero(lang == name)])
                    n = np.bincount(mine, minlength=1 << BITS)
                    seen = np.flatnonzero(n)
                    buckets, counts = np.append(seen, -1), np.append(n[seen], (lang == name).sum())  # -1: rows
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(buckets)), pa.array(buckets), pa.array(counts)], names=["lang", "bucket", "n"])

    sample = named.join(F.broadcast(chosen), "id", "left_semi").select("text", "lang")
    sums = sample.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    rows = sums[sums["bucket"] == -1]
    languages = sorted(rows["lang"][rows["n"] >= least_share * rows["n"].sum()])
    sums = sums[sums["bucket"] >= 0]
    table_ = np.zeros((1 << BITS, len(languages)))
    for k, name in enumerate(languages):
        own = sums[sums["lang"] == name]
        table_[own["bucket"], k] = own["n"]
    table_ = np.log((table_ + 0.1) / (table_ + 0.1).sum(axis=0)) if languages else table_
    return languages, table_.astype(np.float32)


_TAGS = re.compile(r"(?is)<!--.*?-->|<(script|style|nav)\b.*?</\1\s*>|<[^>]*>")


def visible_text(page: str) -> str:
    return html.unescape(_TAGS.sub(" ", page))


def text_evidence(rows: DataFrame, model: tuple[list[str], np.ndarray], markup: bool = False) -> DataFrame:
    """Adds ``grams`` (trigrams) and ``evidence`` (tempered log likelihood of each language, the
    best one 0) to rows with a ``text`` column, which goes. ``markup``: the text is a page."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    _, weights = model
    keep = [c for c in rows.columns if c != "text"]
    schema = StructType([rows.schema[c] for c in keep] + StructType.fromDDL("grams long, evidence array<double>").fields)
    arrow = to_arrow_schema(schema)
    shared = rows.sparkSession.sparkContext.broadcast(weights)  # 65,536 x languages floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            if markup:
                seen = pa.array([visible_text(t or "") for t in batch.column("text").to_pylist()], pa.string())
                batch = batch.set_column(batch.schema.get_field_index("text"), "text", seen)
            for part, texts in _pieces(batch):
                code, at = trigram_buckets(texts)
                sums = np.zeros((len(texts), w.shape[1]))
                for k in range(w.shape[1]):
                    run_sum = np.concatenate(([0.0], np.cumsum(w[:, k][code], dtype=np.float64)))
                    sums[:, k] = run_sum[at[1:]] - run_sum[at[:-1]]
                sums = TEMPER * (sums - sums.max(axis=1, keepdims=True)) if w.shape[1] else sums
                columns = [part.column(c) for c in keep] + [pa.array(np.diff(at)), pa.array(list(sums))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return rows.select(*keep, "text").mapInArrow(run, schema)


def fuse(rows: DataFrame, languages: list[str], keys: list[str], least: float = 0.5) -> DataFrame:
    """Adds lang, posterior and accepted to rows with grams, evidence, declared, suffix, domain, host.

    The posterior is proportional to the host prior, the declared language's likelihood and
    the text's. Counts are those of the text's best language over all rows with letters.
    ``keys`` are columns to keep. Accepted: the text has letters and the posterior is
    ``least`` or more. A null declaration or host is no evidence. Of equal likelihoods or
    posteriors the first language by name counts.
    """
    if not languages:
        return rows.select(*keys, F.lit("und").alias("predicted"), F.lit(0.0).alias("posterior"), F.lit(False).alias("accepted"))
    L = range(len(languages))
    best = F.when(F.col("grams") > 0, F.array_position("evidence", F.array_max("evidence")) - 1)
    rows = rows.withColumn("best", best.cast("int")).withColumn("declared", F.lower("declared"))
    seen = rows.where("best IS NOT NULL")
    votes = lambda *by: seen.groupBy(*by).agg(*[F.count_if(F.col("best") == k).alias(f"v{k}") for k in L])
    named = lambda prefix: [F.col(f"v{k}").alias(f"{prefix}{k}") for k in L]
    # One table of hosts with the counts of each level above; suffixes join it by equality.
    hosts = votes("suffix", "domain", "host").where("host IS NOT NULL").select("suffix", "domain", "host", *named("h"))
    domains = hosts.groupBy("suffix", "domain").agg(*[F.sum(f"h{k}").alias(f"d{k}") for k in L])
    suffixes = domains.groupBy("suffix").agg(*[F.sum(f"d{k}").alias(f"s{k}") for k in L])
    everything = votes().select(*named("g"))
    above = domains.join(suffixes, F.equal_null(domains["suffix"], suffixes["suffix"])).drop(suffixes["suffix"])
    hosts = hosts.join(above.drop("suffix"), "domain").drop("suffix", "domain")
    told = votes("declared").where("declared IS NOT NULL").select("declared", *named("t"))
    told_all = told.agg(*[F.sum(f"t{k}").alias(f"a{k}") for k in L], F.count(F.lit(1)).alias("kinds"))
    # Rows without a host meet no host; they are spread by their evidence.
    spread = F.coalesce("host", F.concat(F.lit(" "), F.xxhash64("evidence", "grams")))
    r = rows.withColumn("host_key", spread).join(hosts.withColumnRenamed("host", "host_key"), "host_key", "left").join(told, "declared", "left").join(F.broadcast(everything.join(F.broadcast(told_all))))

    own = lambda k: F.coalesce((F.col("best") == k).cast("double"), F.lit(0.0))
    n = lambda prefix, k: F.greatest(F.coalesce(F.col(f"{prefix}{k}"), F.lit(0)) - F.when(F.col(f"{prefix}{k}").isNotNull(), own(k)).otherwise(0.0), F.lit(0.0))
    score = []
    for level, prefix in enumerate("gsdh"):
        total = sum((n(prefix, k) for k in L), F.lit(0.0))
        for k in L:
            up = F.lit(1.0 / len(languages)) if not level else F.col(f"p{'gsdh'[level - 1]}{k}")
            r = r.withColumn(f"p{prefix}{k}", (n(prefix, k) + STRENGTH * up) / (total + STRENGTH))
    for k in L:
        share = (n("t", k) + 0.5) / (n("a", k) + 0.5 * (F.coalesce("kinds", F.lit(0)) + 1))
        share = F.when(F.col("declared").isNotNull(), F.log(share)).otherwise(0.0)
        score.append(F.log(F.col(f"ph{k}")) + share + F.coalesce(F.get("evidence", F.lit(k)), F.lit(0.0)))
    r = r.withColumn("score", F.array(*score))
    top = F.array_max("score")
    where = F.array_position("score", top).cast("int")
    weight = F.aggregate("score", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    name = F.when(F.col("grams") > 0, F.try_element_at(F.array(*[F.lit(x) for x in languages]).cast("array<string>"), where))
    return r.select(
        *keys,
        F.coalesce(name, F.lit("und")).alias("predicted"),
        F.round(F.when(F.col("grams") > 0, 1 / weight).otherwise(0.0), 6).alias("posterior"),
    ).withColumn("accepted", (F.col("predicted") != "und") & (F.col("posterior") >= least))


def document_rows(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Documents: declared is ``lang``, the host is ``source``; they have no address. ``keep``:
    further columns."""
    none = F.lit(None).cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), none.cast("long").alias("page_id"), F.col("lang").cast("string").alias("declared"),
        none.alias("suffix"), F.concat(F.lit("source:"), F.col("source")).alias("domain"), F.concat(F.lit("source:"), F.col("source")).alias("host"),
        F.col("text").cast("string").alias("text"), *keep,
    )


def page_rows(pages: DataFrame) -> DataFrame:
    """Pages: declared is the html tag's lang; suffix and domain are the host's last one and two labels."""
    from tarnworks.llm.urlfilter import url_host

    host = url_host(F.col("url"))
    parts = F.split(host, r"\.")
    said = F.regexp_extract("html", r"(?is)<html[^>]*\slang\s*=\s*[\"']?([a-z]{2,3})", 1)
    return pages.select(
        F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"), F.when(said != "", F.lower(said)).alias("declared"),
        F.element_at(parts, -1).alias("suffix"), F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), F.lit(2)), ".").alias("domain"), host.alias("host"),
        F.col("html").cast("string").alias("text"),
    )


KEYS = ["doc_id", "page_id", "declared"]


def identify(docs: DataFrame | None, pages: DataFrame | None, labelled: DataFrame, fit_docs: int = FIT_DOCS, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, page_id, declared, predicted, posterior, accepted): one row a document and a page.
    ``keep``: further columns of the documents, where there are no pages.

    Texts without letters, null and empty ones are ``und`` and not accepted. Null ids and
    repeated rows pass through. Without labelled rows everything is ``und``.
    """
    model = fit_text_model(labelled, fit_docs=fit_docs)
    parts = []
    if docs is not None:
        parts.append(text_evidence(document_rows(docs, keep), model))
    if pages is not None:
        parts.append(text_evidence(page_rows(pages), model, markup=True))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return fuse(materialize(rows, "language-evidence"), model[0], [*KEYS, *keep])


def op3_language_fusion(spark, sf_dir: str) -> DataFrame:
    """The language of every document and every page."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, table(spark, sf_dir, "pages"), docs)
