"""BPE encoding and decoding by prefix-sharing trie traversal.

A batch's distinct words form a trie; sorted, they are its leaves in depth-first order. The
walk gives every node the last token of its prefix's encoding: the one vocabulary suffix
whose preceding state may stand before it. A word's ids are then read off backwards from
its leaf, so a prefix that many words share is encoded once. Words encoded earlier in the
task stay in a bounded cache.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.core.io import table

#: Words that a task's cache holds before it starts anew.
CACHE_WORDS = 500_000
#: Characters of text whose words are taken together.
PIECE_CHARS = 1_000_000
#: Last code point of plane 0. Classes cut there compile to one lookup a character; beyond it each
#: range costs a comparison.
PLANE_0 = 0xFFFF
beyond = re.compile("[\U00010000-\U0010ffff]").search
ENCODED = "n_tokens long, ids array<int>, decoded string"
DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_letters() -> list[str]:
    """Byte-level BPE's letter for every byte: printable Latin-1 stays, the rest moves to U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, moved = [], 0
    for b in range(256):
        out.append(chr(b) if b in printable else chr(256 + moved))
        moved += b not in printable
    return out


def _runs(inside: np.ndarray) -> str:
    """The code points that are true, as ranges of a character class."""
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    return "".join([f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in edges.reshape(-1, 2)])


@functools.cache
def letter_class(kind: str, last: int = sys.maxunicode) -> str:
    """The code points up to ``last`` of a class such as ``\\p{L}`` as the tokenizers library's own Unicode tables
    have it, as ranges of a character class. No letter, number or space lies beyond plane 3."""
    points = np.concatenate((np.arange(0xD800), np.arange(0xE000, 0x40000)))
    split = tokenizers.pre_tokenizers.Split(tokenizers.Regex(f"{kind}+"), "removed")
    inside = np.zeros(0x40000, bool)
    inside[points] = True
    for _, (start, end) in split.pre_tokenize_str("".join(map(chr, points.tolist()))):
        inside[points[start:end]] = False
    return _runs(inside[: last + 1])


@functools.cache
def newer(last: int = sys.maxunicode) -> re.Pattern:
    """A code point up to ``last`` on whose normal form versions of Unicode differ: unknown to Python's tables, or
    combining or composed and younger than Unicode 3.2."""
    old, inside = unicodedata.ucd_3_2_0, np.zeros(sys.maxunicode + 1, bool)
    inside[0x40000:] = True
    for c in range(0x40000):
        x = chr(c)
        if unicodedata.category(x) == "Cn" or (unicodedata.combining(x) or unicodedata.decomposition(x)) and old.category(x) == "Cn":
            inside[c] = True
    return re.compile("[" + _runs(inside[: last + 1]) + "]")


class Cache(dict):
    """Word to [ids, decoded form]; a word that it meets first gets an empty cell and is noted."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> list[str]:
        self.new.append(word)
        cell = self[word] = []
        return cell


class WordBpe:
    """A word-level BPE vocabulary with end-of-word suffix, read from a tokenizers file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.rank: dict[tuple[str, str], int] = {}
        self.halves: dict[str, tuple[str, str]] = {}
        for r, (a, b) in enumerate(model["merges"]):
            self.rank[a, b] = r
            self.halves[a + b] = (a, b)
        self.prefixes = {t[:i] for t in self.vocab for i in range(len(t.removesuffix(self.end)) + 1)}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        #: Classes and, for new code points, normal forms are the library's, whatever versions of
        #: Unicode it and Python have.
        full = plane = pattern
        for kind in (r"\p{L}", r"\p{N}", r"\s"):
            full, plane = full.replace(kind, letter_class(kind)), plane.replace(kind, letter_class(kind, PLANE_0))
        self.split, self.split_plane = re.compile(full).findall, re.compile(plane).findall
        self.normalizer = tokenizers.Tokenizer.from_file(path).normalizer
        #: The same for ASCII text, where the letters and numbers are few.
        self.split_ascii = re.compile(pattern.replace(r"\p{L}", "a-zA-Z").replace(r"\p{N}", "0-9"), re.ASCII).findall
        self.cut = re.compile("|".join(map(re.escape, self.special))).finditer if self.special else None
        self.letters = byte_letters()
        self.spines: tuple[dict, dict] = ({}, {})
        self.reset()

    def reset(self) -> None:
        self.cache = Cache()
        for s, i in self.special.items():
            self.cache[s] = [str(i), s]
        self.fits: dict[tuple[str, str], bool] = {}
        self.steps: dict[tuple[str, str, str], tuple[str, list[str]]] = {}

    def _spine(self, token: str, side: int) -> list[tuple[str, float]]:
        """Pieces on a token's edge (0: right edge, 1: left edge), innermost first, each with
        the rank of the merge that ends it."""
        found = self.spines[side].get(token)
        if found is None:
            found, piece, until = [], token, float("inf")
            while True:
                found.append((piece, until))
                if piece not in self.halves:
                    break
                until = self.rank[self.halves[piece]]
                piece = self.halves[piece][1 - side]
            found.reverse()
            self.spines[side][token] = found
        return found

    def may_follow(self, pair: tuple[str, str]) -> bool:
        """True if BPE leaves the two tokens side by side: no merge takes a piece
        of each while both pieces exist. Of equal ranks the left one merges first."""
        left, right, i, j, found = self._spine(pair[0], 0), self._spine(pair[1], 1), 0, 0, True
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            r = self.rank.get((x, y))
            if r is not None and r < x_until and r <= y_until:
                found = False
                break
            if x_until == y_until == float("inf"):
                break
            if x_until <= y_until:
                i += 1
            else:
                j += 1
        self.fits[pair] = found
        return found

    def _step(self, state: str, letter: str, suffix: str) -> tuple[str, list[str]]:
        """The longest token prefix that ends at the next letter, and the tokens that end
        there, longest first (with ``suffix``: the tokens of a word's end)."""
        at = state + letter
        ends = [t + suffix for i in range(len(at)) if (t := at[i:]) + suffix in self.vocab]
        while at not in self.prefixes:
            at = at[1:]
        return at, ends

    def learn(self, words: Iterable[str]) -> None:
        """Encode distinct words by a depth-first walk of their trie.

        In sorted order the words are the trie's leaves as the walk meets them; ``path`` is
        the way from the root to the current node, with each node's last token.
        """
        spelled = sorted((w if w.isascii() and w.isprintable() else self.spell(w), w) for w in words)
        steps, fits, may_follow, end = self.steps, self.fits, self.may_follow, self.end
        id_of, name_of, cut = self.vocab, self.names, len(self.end)
        path: list[str] = [""]  # the last token of each prefix of the current word
        matched: list[str] = [""]  # and the longest token prefix that ends there
        before = ""
        for letters, word in spelled:
            shared, n = 0, len(letters)
            for x, y in zip(before, letters):
                if x != y:
                    break
                shared += 1
            shared = min(shared, n - 1, len(path) - 1)
            del path[shared + 1 :], matched[shared + 1 :]
            before = letters
            for k in range(shared + 1, n + 1):
                suffix = end if k == n else ""
                key = matched[-1], letters[k - 1], suffix
                found = steps.get(key)
                if found is None:
                    found = steps[key] = self._step(*key)
                for token in found[1]:
                    first = k - len(token) + (cut if suffix else 0)
                    if not first:
                        break
                    pair = path[first], token
                    ok = fits.get(pair)
                    if ok if ok is not None else may_follow(pair):
                        break
                if suffix:
                    break
                path.append(token)
                matched.append(found[0])
            tokens = [token]
            while first:
                tokens.append(token := path[first])
                first -= len(token)
            ids = [id_of[t] for t in reversed(tokens)]
            self.cache[word][:] = " ".join(map(str, ids)), " ".join([name_of[i] for i in ids])

    def spell(self, word: str) -> str:
        return "".join([self.letters[b] for b in word.encode("utf-8", "surrogatepass")])

    def words(self, text: str) -> list[str]:
        """Normalised words of a text; special tokens stay as they are."""
        if self.cut is None or "<|" not in text and not any(s in text for s in self.special):
            return self._plain(text)
        out, at = [], 0
        for m in self.cut(text):
            out += self._plain(text[at : m.start()])
            out.append(m.group())
            at = m.end()
        return out + self._plain(text[at:])

    def _plain(self, text: str) -> list[str]:
        if text.isascii():
            return self.split_ascii(text.lower())
        if (newer() if beyond(text) else newer(PLANE_0)).search(text):
            text = self.normalizer.normalize_str(text)
        else:
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # lower() looks at a capital sigma's neighbours
                text = text.replace("Σ", "σ")
            text = text.lower()
        return (self.split if beyond(text) else self.split_plane)(text)

    def encode(self, texts: list[str]) -> list[tuple[str, str]]:
        """For each text its ids and its decoded form, both joined by spaces."""
        if len(self.cache) > CACHE_WORDS:
            self.reset()
        cells = [list(map(self.cache.__getitem__, self.words(t))) for t in texts]
        self.learn(self.cache.new)
        self.cache.new = []
        return [(" ".join([c[0] for c in row]), " ".join([c[1] for c in row])) for row in cells]


_loaded: dict[str, WordBpe] = {}


def _bpe(path: str) -> WordBpe:
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def encoded(bpe: WordBpe, texts: pa.Array) -> Iterator[tuple[str, str]]:
    """``WordBpe.encode`` over a column, in pieces whose words fit in memory."""
    some, size = [], 0
    for text in texts:
        some.append(text.as_py() or "")
        size += len(some[-1])
        if size > PIECE_CHARS:
            yield from bpe.encode(some)
            some, size = [], 0
    yield from bpe.encode(some)


def _encoded(path: str, keep: list[str], out: pa.Schema, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(path)
        for batch in batches:
            n, first, second = [], [], []
            for joined, back in encoded(bpe, batch.column("text")):
                n.append(joined.count(" ") + 1 if joined else 0)
                if digest:
                    first.append(hashlib.sha256(joined.encode()).hexdigest())
                    second.append(hashlib.sha256(back.encode()).hexdigest())
                else:
                    first.append([int(i) for i in joined.split()])
                    second.append(back)
            columns = [batch.column(c) for c in keep] + [pa.array(n), pa.array(first), pa.array(second)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out)], schema=out)

    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """One row per row of ``docs``: its id, token count, ids and decoded text, or their digests.

    Ids as the tokenizers library's encode(text, add_special_tokens=False) gives them for
    the file at ``path``, for any text; decoded as decode(ids, skip_special_tokens=False): token names
    joined by spaces. A null text is empty: no tokens, empty text. Null ids and repeated
    rows pass through; other columns are not read. No shuffle: each task encodes its rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    d = docs.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("text"))
    schema = StructType([d.schema[0]])
    tail = StructType.fromDDL(DIGEST if digest else ENCODED)
    schema = StructType([*schema.fields, *tail.fields])
    return d.mapInArrow(_encoded(path, [id_col], to_arrow_schema(schema), digest), schema)


def op7_bpe_trie(spark, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text for every document."""
    import public_tokenizers

    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), digest=True)
