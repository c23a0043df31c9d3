"""Secret scans: candidates by pattern, false positives removed by a random forest.

The forest sees a candidate's length, character transitions, dictionary coverage, path and
neighbouring words. It is trained with Spark ML on labelled findings and its trees, of
bounded size, go to the tasks, so scanning and redacting need no shuffle of texts.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.core.io import materialize, table

#: Labelled findings that fit the forest at most.
FIT_FINDINGS = 20_000
TREES, DEPTH = 16, 6
#: What may be a secret: runs of token characters, 16 at least, and the values and blocks below.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_\-]{16,}")
#: Words before a secret (fixed values), each a feature of its own.
NEIGHBOURS = ["token", "password", "passwd", "secret", "key", "api", "auth", "bearer", "credential", "commit", "sha", "id", "card"]
#: Parts of paths that hold made-up secrets (fixed values).
PATH_PARTS = ["test", "example", "sample", "doc", "mock"]
HASHED = 8
#: Formats whose issuer fixes them: a finding that is one as a whole is a secret.
ISSUED = re.compile(
    r"(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}|github_pat_\w{60,}|glpat-[\w\-]{20,}|(?:sk|rk)_(?:live|test)_[0-9A-Za-z]{16,}|whsec_[0-9A-Za-z+/]{24,}"
    r"|xox[abeoprs]-[0-9A-Za-z\-]{10,}|xapp-[0-9A-Za-z\-]{20,}|AIza[\w\-]{35}|GOCSPX-[\w\-]{20,}|sk-(?:[a-z]+\d*-)?(?=[\w\-]*\d)[\w\-]{20,}|npm_[0-9A-Za-z]{36}|hf_[0-9A-Za-z]{30,}|pypi-[\w\-]{50,}"
    r"|SG\.[\w\-]{16,}\.[\w\-]{16,}|eyJ[\w\-]{8,}\.[\w\-]{8,}(?:\.[\w\-]*)?|dop_v1_[0-9a-f]{64}|shp(?:at|ca|pa|ss)_[0-9a-fA-F]{32}|key-[0-9a-f]{32}|ya29\.[\w\-]{20,}"
    r"|-----BEGIN [\s\S]*)\Z"
)
#: Bodies of PEM private keys, cut ones as well.
PEM = re.compile(
    r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
    r"(?:(?:(?!-----)[\s\S]){0,20000}-----END [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----|(?:\s*[\w\-]+: [^\n]*\n)*+(?:[\s\\\"',#*>]*+[A-Za-z0-9+/=]{16,}+)++(?:\s[A-Za-z0-9+/]{1,15}={1,2})?|)"
)
#: Tokens of parts with dots between.
DOTTED = re.compile(r"SG\.[\w\-]{16,}\.[\w\-]{16,}|eyJ[\w\-]{8,}\.[\w\-]{8,}(?:\.[\w\-]*)?|ya29\.[\w\-]{20,}|(?<![\w\-.])[A-Za-z0-9_\-]{16,}\.[A-Za-z0-9_\-]{6,}\.[A-Za-z0-9_\-]{16,}")
#: Assigned values of any characters, 8 at least, quoted or up to white space.
ASSIGNMENT = re.compile(
    r"(?:=>|[=:])[ \t]*(?:(?:[Bb]earer|[Bb]asic|[Tt]oken|BEARER|BASIC)[ \t]+)?(?:\"([^\"\n]{8,512})\"|'([^'\n]{8,512})'|`([^`\n]{8,512})`|([^\s\"'`<>=][^\s\"'`<>]{7,511}))"
)
#: Values of an authorization scheme, and passwords in addresses.
SCHEME = re.compile(r"\b(?:[Bb]earer|[Bb]asic|BEARER|BASIC)[ \t]+[\"']?([A-Za-z0-9._~+/=\-]{8,})")
ADDRESS = re.compile(r"://[^\s:/@\"'<>]{0,128}:([^\s/@\"'<>]{4,256})@")
NAMES = r"(?:token|password|passwd|passphrase|pwd|secret|api[_-]?key|access[_-]?key|private[_-]?key|auth[_-]?key|signing[_-]?key|encryption[_-]?key|credentials?|authorization|client[_-]?key)"
ASSIGNED = re.compile(rf"(?i){NAMES}[\w\-]{{0,24}}[\"'`\]]?\s*\Z")
#: What follows a value and does not belong to it.
TRAILING = ".,;:!?)]}"
#: Made-up values, and words before digests: neither is a secret.
PLACEHOLDER = re.compile(r"(?i)\$\{|\{\{|\$\(|\A<[^>]*>\Z|%\(|\*{4}|x{6}|\.{3}|\A(?:your|my|insert|replace|enter)[_\- ]|changeme|placeholder|redacted|example\Z|os\.environ|getenv|process\.env")
DIGEST = re.compile(r"(?i)(?:commit|sha-?\d*|md5|checksum|digest|revision|rev|hash|etag|integrity|uuid)\W{0,4}\Z")
#: Assigned values that are code: calls, dotted names, paths, and words joined by underscores.
CODE = re.compile(r"[A-Za-z_][\w.]*\(.*|[A-Za-z_]\w*(?:\.[A-Za-z_]\w*)+(?:\[.*)?|(?:\.{0,2}/|~/|[A-Za-z]:\\)[\w./\\\-]+|[A-Za-z]+\d{0,4}(?:_(?:[A-Za-z]+\d{0,4}|\d{1,4}))+", re.S)
_LETTERS = re.compile(r"[a-zà-öø-ÿ]+")

FEATURES = [
    "length", "digits", "upper", "lower", "hex", "distinct", "entropy", "class_changes", "letter_digit", "dictionary", "words", "longest_word",
    "quote_before", "assign_before", "space_after", *[f"near_{w}" for w in NEIGHBOURS], *[f"word_{i}" for i in range(HASHED)],
    *[f"path_{p}" for p in PATH_PARTS], *[f"path_hash_{i}" for i in range(HASHED)],
]


@dataclass(frozen=True)
class Dictionary:
    """Words, and trigrams inside words, that are common in the corpus."""

    words: frozenset[str]
    trigrams: frozenset[str]


#: ASCII letters in lower case; all else parts words.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 else 32 for b in range(256))


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n): how often each run of 3 to 24 ASCII letters occurs in all texts, in lower case."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        give = lambda: pa.RecordBatch.from_arrays([pa.array([w.decode() for w in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
        for batch in batches:
            for t in batch.column(0):
                seen.update(w for w in (t.as_py() or "").encode("utf-8", "surrogatepass").translate(_WORDS).split() if 2 < len(w) < 25)
                if len(seen) > 200_000:
                    yield give()
                    seen.clear()
        if seen:
            yield give()

    return docs.select(F.col(text_col).cast("string")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def corpus_dictionary(docs: DataFrame, text_col: str = "text", word_share: float = 1e-5, share: float = 1e-4) -> Dictionary:
    """Words that make up ``word_share`` or more of all, so 1 / ``word_share`` at most, and trigrams
    that make up ``share`` or more of those in all words (at most 17,576 exist)."""
    counts = materialize(word_counts(docs, text_col), "secret-words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    words = counts.where(F.col("n") >= word_share * total).toPandas()["word"]
    grams = F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 2), lambda i: F.substring("word", i, F.lit(3))))
    trigrams = counts.select(grams.alias("trigram"), "n").groupBy("trigram").agg(F.sum("n").alias("n")).toPandas()
    return Dictionary(frozenset(words), frozenset(trigrams["trigram"][trigrams["n"] >= share * trigrams["n"].sum()]))


def features(text: str, start: int, end: int, path: str, dictionary: Dictionary) -> list[float]:
    c = text[start:end]
    n = len(c)
    kinds = ["d" if x.isdigit() else "u" if x.isupper() else "l" if x.islower() else "p" for x in c]
    count = Counter(c)
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    swaps = sum((a == "d") != (b == "d") for a, b in zip(kinds, kinds[1:]))
    words = _LETTERS.findall(c.lower())
    grams = [w[i : i + 3] for w in words for i in range(len(w) - 2)]
    before = text[max(0, start - 32) : start]
    near = _LETTERS.findall(before.lower())
    tail = before.rstrip()
    path = path.lower()
    hashed = [0.0] * HASHED
    if near:
        hashed[zlib.crc32(near[-1].encode()) % HASHED] = 1.0
    of_path = [0.0] * HASHED
    of_path[zlib.crc32(path.encode("utf-8", "surrogatepass")) % HASHED] = 1.0
    return [
        float(n), kinds.count("d") / n, kinds.count("u") / n, kinds.count("l") / n, sum(x in "0123456789abcdefABCDEF" for x in c) / n,
        len(count) / n, -sum(k / n * math.log2(k / n) for k in count.values()), changes / n, swaps / n,
        sum(g in dictionary.trigrams for g in grams) / max(1, n - 2), sum(len(w) for w in words if w in dictionary.words) / n, max(map(len, words), default=0) / n,
        float(before[-1:] in ("'", '"')), float(tail.rstrip("\"'").rstrip()[-1:] in ("=", ":")), float(text[end : end + 1].isspace()),
        *[float(w in near[-3:]) for w in NEIGHBOURS], *hashed, *[float(p in path) for p in PATH_PARTS], *of_path,
    ]


FINDING = "start int, end int, label int, issued boolean, features array<double>"


def candidates(docs: DataFrame, dictionary: Dictionary, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """(id, start, end, label, issued, features) of every candidate in the whole text.

    ``label`` as of ``labelled``, null without evidence; ``issued`` where the format alone tells. Null texts have no candidate; null
    paths are empty.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    d = docs.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"))
    schema = StructType([d.schema[0], *StructType.fromDDL(FINDING).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, start, end, label, issued, row = [], [], [], [], [], []
            paths = batch.column("path")
            for i, t in enumerate(batch.column("text")):
                text = t.as_py() or ""
                for first, last, told in spans(text):
                    at.append(i)
                    start.append(first)
                    end.append(last)
                    label.append(labelled(text, first, last, told))
                    issued.append(ISSUED.match(text[first:last]) is not None)
                    row.append(features(text, first, last, paths[i].as_py(), dictionary))
            ids = batch.column(0).take(pa.array(at, pa.int64()))
            columns = [ids] + [pa.array(x, arrow.field(k + 1).type) for k, x in enumerate((start, end, label, issued, row))]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return d.mapInArrow(run, schema)


def spans(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, told) of all candidates of a text, in order and apart; ``told``: a block, or a
    value that stands after a secret's name or an authorization scheme, or in an address."""
    found = [(m.start(), m.end(), False) for m in CANDIDATE.finditer(text)]
    if "-----BEGIN" in text:
        found += [(m.start(), m.end(), True) for m in PEM.finditer(text)]
    if "." in text:
        found += [(m.start(), m.end(), False) for m in DOTTED.finditer(text)]
    at = 0
    while m := ASSIGNMENT.search(text, at):
        at = m.start() + 1
        if ASSIGNED.search(text[max(0, m.start() - 64) : m.start()]):
            start, end = m.span(m.lastindex)
            if m.lastindex == 4:
                end = start + len(text[start:end].rstrip(TRAILING))
            if end - start >= 8:
                found.append((start, end, True))
                at = end
    if "earer" in text or "asic" in text or "EARER" in text or "ASIC" in text:
        found += [(m.start(1), m.end(1), True) for m in SCHEME.finditer(text)]
    if "://" in text and "@" in text:
        found += [(m.start(1), m.end(1), True) for m in ADDRESS.finditer(text)]
    out: list[tuple[int, int, bool]] = []
    for start, end, told in sorted(found):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]), told or out[-1][2])
        else:
            out.append((start, end, told))
    return out


def labelled(text: str, start: int, end: int, told: bool) -> int | None:
    """1: an issuer's format, or a told value of mixed characters that is not made up. 0: words,
    numbers, code, paths, digests and made-up values. None: no evidence either way."""
    c = text[start:end]
    if ISSUED.match(c):
        return 1
    digit, letter = any(x.isdigit() for x in c), any(x.isalpha() for x in c)
    if PLACEHOLDER.search(c) or CODE.fullmatch(c):
        return 0
    if told:
        mixed = digit or (not c.isalnum() and any(x in "!@#$%^&*~+" for x in c))
        return 1 if mixed else None
    if not digit or not letter:
        return 0
    return 0 if DIGEST.search(text[max(0, start - 32) : start]) else None


def fit_rows(findings: DataFrame, fit_findings: int = FIT_FINDINGS) -> DataFrame:
    """(label, features as a vector) of at most ``fit_findings`` labelled findings: of more, those
    whose features' digests are smallest. Rows with a null label or features take no part."""
    from pyspark.ml.functions import array_to_vector

    rows = findings.select(F.col("label").cast("double").alias("label"), "features").dropna()
    rows = rows.orderBy(F.xxhash64("features"), "label").limit(fit_findings)
    return materialize(rows.select("label", array_to_vector("features").alias("features")).coalesce(1), "secret-fit")


def train_model(fit: DataFrame, trees: int = TREES, depth: int = DEPTH):
    """Spark ML's random forest over ``fit_rows``."""
    from pyspark.ml.classification import RandomForestClassifier

    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7, subsamplingRate=0.8, featureSubsetStrategy="sqrt").fit(fit)


def forest_arrays(model) -> list[dict[str, np.ndarray]]:
    """The trees of Spark ML's model, small enough to go to every task."""
    return [_arrays(tree._java_obj.rootNode()) if hasattr(tree, "_java_obj") else _arrays(tree) for tree in model.trees]


def train_forest(findings: DataFrame, fit_findings: int = FIT_FINDINGS, trees: int = TREES, depth: int = DEPTH) -> list[dict[str, np.ndarray]]:
    """A forest from labelled findings (label, features), at most ``fit_findings`` of them.

    Without both labels the forest answers the share of label 1.
    """
    fit = fit_rows(findings, fit_findings)
    found = {r["label"] for r in fit.select("label").distinct().collect()}
    if found != {0.0, 1.0}:
        share = float(found == {1.0})
        return [{"feature": np.array([-1]), "split": np.zeros(1), "left": np.zeros(1, int), "right": np.zeros(1, int), "share": np.array([share])}]
    return forest_arrays(train_model(fit, trees, depth))


def _arrays(node) -> dict[str, np.ndarray]:
    """A tree's nodes as arrays: feature (-1: leaf), split, left, right, share of label 1."""
    out = {"feature": [], "split": [], "left": [], "right": [], "share": []}

    def walk(x) -> int:
        k = len(out["feature"])
        stats = list(x.impurityStats().stats())
        for name, v in (("feature", -1), ("split", 0.0), ("left", 0), ("right", 0), ("share", stats[1] / max(sum(stats), 1e-9))):
            out[name].append(v)
        if x.subtreeDepth():
            out["feature"][k] = x.split().featureIndex()
            out["split"][k] = x.split().threshold()
            out["left"][k] = walk(x.leftChild())
            out["right"][k] = walk(x.rightChild())
        return k

    walk(node)
    return {k: np.asarray(v) for k, v in out.items()}


def score(forest: list[dict[str, np.ndarray]], rows: np.ndarray) -> np.ndarray:
    """Mean share of label 1 in the leaves that each row reaches."""
    total = np.zeros(len(rows))
    for tree in forest:
        at = np.zeros(len(rows), np.int64)
        while True:
            feature = tree["feature"][at]
            inner = feature >= 0
            if not inner.any():
                break
            low = rows[np.arange(len(rows)), np.maximum(feature, 0)] <= tree["split"][at]
            at = np.where(inner, np.where(low, tree["left"][at], tree["right"][at]), at)
        total += tree["share"][at]
    return total / max(1, len(forest))


def scored(findings: DataFrame, forest: list[dict[str, np.ndarray]], id_col: str = "doc_id", least: float = 0.5) -> DataFrame:
    """(id, start, end, score, is_secret) of findings with features: the forest decides, a score of
    ``least`` or more is a secret; ``issued`` findings, whose format an issuer fixes, are certain."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    d = findings.select(id_col, "start", "end", "features", "issued")
    schema = StructType([*list(d.schema)[:3], *StructType.fromDDL("score double, is_secret boolean").fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = score(forest, np.array(batch.column("features").to_pylist(), float).reshape(-1, len(FEATURES))).round(6)
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(3)] + [pa.array(p), pa.array((p >= least) | np.array(batch.column("issued").to_pylist(), bool))], schema=arrow)

    return d.mapInArrow(run, schema)


def fitted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source", fit_findings: int = FIT_FINDINGS):
    """(dictionary, forest): the dictionary of all texts, and a forest fitted on the findings of
    the documents that ``labels`` names."""
    dictionary = corpus_dictionary(docs, text_col)
    found = candidates(docs, dictionary, id_col, text_col, path_col)
    own = labels.select(F.col("doc_id").alias(id_col)).distinct()
    return dictionary, train_forest(found.join(own, id_col, "left_semi"), fit_findings)


def redact(docs: DataFrame, dictionary: Dictionary, forest: list, text_col: str = "text", path_col: str = "source", least: float = 0.5, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each secret in the text replaced by ``mark``; all rows and columns stay, and
    n_chars, where there is one, is the new length. Null texts stay null."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = docs.schema
    arrow = to_arrow_schema(schema)
    at_text, at_path = docs.columns.index(text_col), docs.columns.index(path_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, paths = batch.column(at_text).to_pylist(), batch.column(at_path).to_pylist()
            found, rows, issued = [], [], []
            for i, text in enumerate(texts):
                for a, b, _ in spans(text or ""):
                    found.append((i, a, b))
                    issued.append(ISSUED.match(text[a:b]) is not None)
                    rows.append(features(text, a, b, paths[i] or "", dictionary))
            if rows:
                bad = (score(forest, np.array(rows)) >= least) | np.array(issued)
                for (i, a, b), secret in zip(reversed(found), bad[::-1]):
                    if secret:
                        texts[i] = texts[i][:a] + mark + texts[i][b:]
            columns = list(batch.columns)
            columns[at_text] = pa.array(texts, arrow.field(at_text).type)
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    out = docs.mapInArrow(run, schema)
    return out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op6_secret_forest(spark, sf_dir: str) -> DataFrame:
    """Every candidate of every document with the forest's verdict."""
    docs = table(spark, sf_dir, "documents")
    dictionary = corpus_dictionary(docs)
    found = materialize(candidates(docs, dictionary), "secret-candidates")
    own = table(spark, sf_dir, "labels").select("doc_id").distinct()
    return scored(found, train_forest(found.join(own, "doc_id", "left_semi")))
