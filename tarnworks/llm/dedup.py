"""Near duplicates: SuperMinHash signatures, banding, verification on full sets, components.

A document's set is its distinct word shingles, hashed to 64 bits. SuperMinHash gives each
shingle correlated ranks: at level j it takes the next place of its own permutation with a
value in [j, j + 1), so a signature is complete once every place holds a value below the
level - for most documents after one or two levels.

Documents with equal sets form a class; the rest works on one representative a class. In a
band's bucket, members are linked with its most central one first. Where components stay apart
inside a bucket, members meet some more pivots, and at last the pairs of different components
that bounds on their common shingles leave: no link that banding finds is lost, members of one
component are never paired, and a bucket's members are not paired with each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.core.graph import connected_components
from tarnworks.core.io import bucketed, materialize, table

#: Bands of the signature and values in each: at similarity 0.8 a pair shares no band with
#: probability (1 - 0.8 ** 5) ** 36 = 6e-7.
BANDS, BAND_ROWS = 36, 5
#: Bits of the filter by which tasks tell documents whose sets are needed from others: 8 MB.
SPOTS = 1 << 26
#: Pairs of one document that meet one copy of its set.
MOST_PAIRS = 1_000
#: Text bytes whose shingles and signatures are made together.
PIECE = 1_500_000
#: Pairs at the limit that the bands of differences may miss, and how many such bands a set has at most.
MISS, MOST_BANDS = 1e-5, 1024
#: Classes of pairs by their differences' size over the difference that a link allows; the first holds all smaller ones.
SPREAD = [1.8, 2.3, 2.8, 3.4, 4.0, 5.0, 7.0]
_MUL = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * _MUL[1]
    x = (x ^ (x >> np.uint64(27))) * _MUL[2]
    return x ^ (x >> np.uint64(31))


_grown: dict[int, np.ndarray] = {}


def _powers(n: int, base: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; kept, as every piece needs them."""
    found = _grown.get(base)
    if found is None or len(found) < n:
        found = np.full(max(n, 2 * PIECE), base, np.uint64)
        found[0] = 1
        found = np.multiply.accumulate(found)
        if n <= 4 * PIECE:
            _grown[base] = found
    return found[:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of the texts, A-Z lowered, and each text's first word's index.

    Words are the runs of bytes other than space and 9 to 13.
    """
    raw = _LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    gap = _SPACE[raw]
    word = ~gap
    starts = np.flatnonzero(word & np.concatenate(([True], gap[:-1])))
    ends = np.flatnonzero(gap & np.concatenate(([False], word[:-1])))
    base = 0x100000001B3
    inverse = pow(base, -1, 1 << 64)
    letters = _mix((raw.astype(np.uint64) + np.uint64(1)) * _MUL[0])
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(letters * _powers(len(raw), base), dtype=np.uint64)))
    h = (sums[ends] - sums[starts]) * _powers(len(raw), inverse)[starts]
    h = _mix(h ^ _mix((ends - starts).astype(np.uint64) * _MUL[0]))
    first = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    return h, np.searchsorted(starts, first)


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, text after text, and each one's bounds.

    Fewer words than ``size``: the whole sequence is the one shingle; no words: no shingle.
    """
    words, first = word_hashes(texts)
    n_words = np.diff(first)
    n = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    owner = np.repeat(np.arange(len(texts)), n)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + first[owner]
    end = first[owner + 1]
    h = np.full(len(at), 1, np.uint64)
    padded = np.concatenate((words, np.zeros(size, np.uint64)))
    for k in range(size):
        h = _mix(h * _MUL[0] + np.where(at + k < end, padded[at + k], np.uint64(k)))
    small = owner.astype(np.uint16) if len(texts) < 1 << 16 else owner
    order = np.lexsort((h, small))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    return h, np.searchsorted(owner, np.arange(len(texts) + 1))


def super_minhash(h: np.ndarray, bounds: np.ndarray, m: int) -> np.ndarray:
    """SuperMinHash signatures (documents x m) of sets of 64-bit hashes; empty sets: infinity.

    Level j of an element: a random value j + r and the j-th entry of its permutation, drawn
    by a Fisher-Yates step. A document leaves after the level that fills its last place.
    """
    n = len(bounds) - 1
    out = np.full((n, m), np.inf)
    sizes = np.diff(bounds)
    doc = np.repeat(np.arange(n), sizes)
    element = h
    drawn: list[np.ndarray] = []  # the places drawn at earlier levels, by element
    for j in range(m):
        if not len(doc):
            break
        random = _mix(element ^ _mix(np.array([j + 1], np.uint64) * _MUL[0]))
        r = (random >> np.uint64(11)).astype(np.float64) / (1 << 53)
        pick = j + (_mix(random + _MUL[:1]) % np.uint64(m - j)).astype(np.int64)
        # The permutation after j swaps, at place ``pick``: follow the swaps backwards.
        place = pick.copy()
        for i in range(j - 1, -1, -1):
            moved = drawn[i]
            place = np.where(place == moved, i, place)
        drawn.append(pick)
        flat = doc * m + place
        np.minimum.at(out.reshape(-1), flat, j + r)
        full = np.isfinite(out).all(axis=1)
        keep = ~full[doc]
        if not keep.all():
            doc, element, drawn = doc[keep], element[keep], [d[keep] for d in drawn]
    return out


def _pieces(ids: pa.Array, texts: pa.Array) -> Iterator[tuple[pa.Array, list[bytes]]]:
    at, some, size = 0, [], 0
    for i, t in enumerate(texts):
        some.append((t.as_py() or "").encode("utf-8", "surrogatepass"))
        size += len(some[-1])
        if size > PIECE:
            yield ids.slice(at, len(some)), some
            at, some, size = i + 1, [], 0
    if some:
        yield ids.slice(at, len(some)), some


def _lists(flat: np.ndarray, width: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, flat.size + 1, width, dtype=np.int32)), pa.array(flat.reshape(-1)))


def signatures(docs: DataFrame, size: int, bands: int = BANDS, rows: int = BAND_ROWS) -> DataFrame:
    """(doc_id, n_shingles, set_key, bands) of (doc_id, text): the set's size and 128-bit
    digest, and a 64-bit bucket of each band (none for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            for ids, texts in _pieces(batch.column(0), batch.column(1)):
                h, bounds = shingle_sets(texts, size)
                sig = super_minhash(h, bounds, bands * rows).view(np.uint64).reshape(len(texts), bands, rows)
                bucket = np.broadcast_to(_mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(texts), bands))
                for k in range(rows):
                    bucket = _mix(bucket * _MUL[0] + sig[:, :, k])
                raw = h.tobytes()
                keys = [hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).digest() for a, b in zip(bounds[:-1], bounds[1:])]
                columns = [ids, pa.array(np.diff(bounds)), pa.array(keys, pa.binary()), _lists(bucket.astype(np.int64), bands)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "set_key", "bands"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, bands array<long>")


def _spot(doc: str):
    return F.pmod(F.xxhash64(doc), F.lit(SPOTS)) + 1  # bitmap buckets count from 1


def full_sets(docs: DataFrame, size: int, wanted: DataFrame) -> DataFrame:
    """(doc_id, set_key, shingles): the digest and the sorted set, as 8-byte hashes, of the texts
    whose doc_id is ``wanted``, and of a few others.

    A filter of ``SPOTS`` bits goes to the tasks, so texts are not shuffled to find the wanted
    ones; where it gets full, more sets than needed are made.
    """
    bits = wanted.select(_spot("doc_id").alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("part"))
    held = np.zeros(SPOTS // 8, np.uint8)
    for r in bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits")).collect():
        at = (r["part"] - 1) * len(r["bits"])
        held[at : at + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            number, bit = np.divmod(batch.column(2).to_numpy(), 8)
            batch = batch.filter(pa.array((shared.value[number] >> bit & 1).astype(bool)))
            for ids, texts in _pieces(batch.column(0), batch.column(1)):
                h, bounds = shingle_sets(texts, size)
                raw = h.tobytes()
                sets = [raw[8 * a : 8 * b] for a, b in zip(bounds[:-1], bounds[1:])]
                keys = [hashlib.blake2b(x, digest_size=16).digest() for x in sets]
                yield pa.RecordBatch.from_arrays([ids, pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], names=["doc_id", "set_key", "shingles"])

    return docs.select("doc_id", "text", (_spot("doc_id") - 1).alias("spot")).mapInArrow(run, "doc_id long, set_key binary, shingles binary")


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size of the intersection and of the union of each pair's sets."""
    for batch in batches:
        both, either = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
        for i, (x, y) in enumerate(zip(batch.column("set_a"), batch.column("set_b"))):
            x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            both[i] = int((y[at] == x).sum()) if len(y) else 0
            either[i] = len(x) + len(y) - both[i]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(both), pa.array(either)], names=["a", "b", "both", "either"])


def _outside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each pair's common shingles, the size of its union, the shingles of b outside a, and those
    that only one of them has."""
    for batch in batches:
        common, either, rest, delta = [], [], [], []
        for x, y in zip(batch.column("set_a"), batch.column("set_b")):
            x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            new = np.setdiff1d(y, x, assume_unique=True)
            common.append(len(y) - len(new))
            either.append(len(x) + len(new))
            rest.append(new.astype(np.int64))
            delta.append(np.concatenate([new, np.setdiff1d(x, y, assume_unique=True)]).view(np.int64))
        sets = [pa.array(c, pa.list_(pa.int64())) for c in (rest, delta)]
        columns = [batch.column("b"), batch.column("a"), pa.array(common, pa.int64()), pa.array(either, pa.int64()), *sets]
        yield pa.RecordBatch.from_arrays(columns, names=["doc", "p", "common", "either", "outside", "delta"])


def difference_bands(kind: int, members: int) -> tuple[int, int]:
    """Rows a band and bands for differences of a class in a group of so many members.

    Two linked sets whose differences to the pivot have u times the size that a link allows between
    them have differences of similarity (u - 1) / (u + 1) at least. Rows grow with the logarithm of
    the group; bands are as many as keep a pair at the limit from being missed more often than
    ``MISS``, and rows as few as keep these below ``MOST_BANDS``.
    """
    least = (SPREAD[kind] - 1) / (SPREAD[kind] + 1)
    count = lambda rows: int(np.ceil(np.log(MISS) / np.log1p(-(least**rows))))
    rows = max(2, min(12, round(np.log2(max(members, 2))) - 4))
    while rows > 1 and count(rows) > MOST_BANDS:
        rows -= 1
    return rows, count(rows)


def _difference_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Band keys of each member's difference to its pivot, under each class that is asked of it."""
    for batch in batches:
        for i, (delta, kinds, members) in enumerate(zip(batch.column("delta"), batch.column("kinds").to_pylist(), batch.column("members").to_pylist())):
            x = delta.values.to_numpy().view(np.uint64)
            of, keys = [], []
            for kind in kinds:
                rows, bands = difference_bands(kind, members)
                seed = _mix(np.arange(1, rows * bands + 1, dtype=np.uint64) * _MUL[0]) | np.uint64(1)
                low = np.concatenate([np.multiply.outer(s, x).min(axis=1) for s in np.array_split(seed, max(1, len(seed) * len(x) // PIECE))])
                key = np.arange(bands, dtype=np.uint64)
                for values in low.reshape(bands, rows).T:
                    key = _mix(key ^ values)
                of += [kind] * bands
                keys.append(key.view(np.int64))
            if keys:
                same = [pa.array(np.full(len(of), v)) for v in (batch.column("p")[i].as_py(), batch.column("doc")[i].as_py())]
                yield pa.RecordBatch.from_arrays([*same, pa.array(of, pa.int32()), pa.array(np.concatenate(keys))], names=["p", "doc", "kind", "key"])


def _alike_differences(enough: DataFrame, near: DataFrame, names: dict[str, str], percent: int) -> DataFrame:
    """Pairs of members that are not linked with their pivot p, by bands of their differences to p.

    Two sets differ by what their differences to p differ by. A link allows t (|A| + |B|) of that, t
    being (100 - percent) / (100 + percent); a set that is not linked with p differs by more from p, so
    the differences of a pair that is linked have much in common. A pair's class is that of its
    u, its differences over what it allows; a member has keys under each class that it can reach
    with some member of its group.
    """
    allowed = F.lit((100 - percent) / (100 + percent))
    d = enough.join(near.where("NOT linked").select("p", "doc", "delta"), ["p", "doc"]).withColumn("u", F.col("differ") / (allowed * F.col("n")))
    d = materialize(d, "dedup-differences")
    group = d.groupBy("p").agg(F.count(F.lit(1)).alias("members"), F.min("u").alias("low"), F.max("u").alias("high")).where("members > 1")
    # A pair's u lies between its members', nearer to the larger one's: sizes differ by percent at most.
    w = 100 / (100 + percent) + 1e-9
    least = F.greatest((1 - w) * F.col("u") + w * F.col("low"), F.col("low")) - 1e-9
    most = F.least((1 - w) * F.col("u") + w * F.col("high"), F.col("high")) + 1e-9
    ends = F.array(*[F.struct(F.lit(i).alias("k"), F.lit(x if i else 0.0).alias("a"), F.lit(y).alias("b")) for i, (x, y) in enumerate(zip(SPREAD, [*SPREAD[1:], 1e300]))])
    kinds = F.transform(F.filter(ends, lambda e: (e["a"] <= most) & (e["b"] > least)), lambda e: e["k"])
    asked = d.join(group, "p").select("p", "doc", "delta", kinds.alias("kinds"), "members")
    keys = asked.mapInArrow(_difference_keys, "p long, doc long, kind int, key long")
    keys = materialize(keys.join(d.select("p", *names, "differ"), ["p", "doc"]), "dedup-difference-keys")
    other = keys.select("p", "kind", "key", F.col("differ").alias("differ_b"), *[F.col(k).alias(v) for k, v in names.items()])
    apart = (F.col("component") != F.col("component_b")) & (F.col("near_p_b") | (F.col("doc") < F.col("doc_b")))
    u = (F.col("differ") + F.col("differ_b")) / (allowed * (F.col("n") + F.col("n_b")))
    of_pair = sum((u >= x).cast("int") for x in SPREAD[1:])
    return keys.where("NOT near_p").join(other, ["p", "kind", "key"]).where(apart & (F.col("kind") == of_pair))


def _possible(n_a: str, n_b: str, percent: int):
    """Sets of these sizes can be that similar at all: exact, as the smaller bounds the overlap."""
    return (F.col(n_a) * 100 >= F.col(n_b) * percent) & (F.col(n_b) * 100 >= F.col(n_a) * percent)


def near_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = BAND_ROWS,
    rounds: int = 2,
    heavy: int = 16,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row a document.

    Documents are linked where 100 * |A and B| >= percent * |A or B| for their sets of
    ``size``-word shingles; component_id is the smallest doc_id that links reach, and that
    document is the one kept. Null and empty texts have no shingle and no link. Rows that
    repeat id and set count once; an id with several texts is linked through any of them. A
    row with a null id is a document that nothing is linked with: component_id null, kept.
    Other columns are not read.

    ``rounds`` (pivots that a bucket's members meet before pairs are sought) and ``heavy``
    (holders from which a shingle counts as the pivot's) divide the work; links do not depend
    on them.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = materialize(signatures(d, size, bands, rows), "dedup-signatures")
    named = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # Ids with several sets: their sets are nodes of their own, named by the set; other nodes
    # have the smallest doc_id of their set's rows.
    several = named.groupBy("doc_id").agg(F.min("set_key").alias("low"), F.max("set_key").alias("high")).where("low < high")
    several = materialize(several.select("doc_id", F.lit(True).alias("several")), "dedup-several")
    node = F.when(F.col("several"), F.xxhash64("set_key")).otherwise(F.col("doc_id"))
    classes = named.groupBy("set_key").agg(F.min("doc_id").alias("doc_id")).join(several, "doc_id", "left")
    classes = materialize(classes.select("set_key", "doc_id", node.alias("node"), "several"), "dedup-classes")
    of_class = classes.select("set_key", F.col("doc_id").alias("rep"))

    # Members of the buckets that hold more than one class.
    banded = signed.join(classes, ["set_key", "doc_id"]).select(
        F.col("node").alias("doc"), F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket")
    )
    banded = banded.repartition("bucket")  # once, for both sides of the join
    shared = banded.groupBy("bucket").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high")
    members = materialize(banded.join(shared.select("bucket"), "bucket").dropDuplicates(["bucket", "doc"]), "dedup-members")
    # How central a document is: the members of all its buckets. The original of a group of
    # changed copies shares more bands than any of them.
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    central = members.join(sizes, "bucket").groupBy("doc").agg(F.sum("size").alias("central"))
    members = materialize(members.join(central, "doc"), "dedup-members")
    wanted = members.select("doc").distinct()
    reps = classes.join(wanted, F.col("node") == F.col("doc"), "left_semi").select("doc_id").distinct()
    sets = full_sets(d.where("doc_id IS NOT NULL"), size, reps).where(F.length("shingles") > 0).join(several, "doc_id", "left")
    sets = bucketed(sets.select(node.alias("doc_id"), "shingles"), "doc_id", "dedup-sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are links."""
        found = with_sets(pairs, sets).mapInArrow(_common, "a long, b long, both long, either long")
        return found.where(F.col("both") * 100 >= F.col("either") * percent).select("a", "b")

    def still_apart(at: DataFrame, links: DataFrame) -> DataFrame:
        """Members, with their component, of the buckets that hold more than one."""
        label = connected_components(links).withColumnRenamed("node", "doc")
        at = at.drop("component").join(label, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
        mixed = at.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
        return materialize(at.join(mixed.select("bucket"), "bucket"), "dedup-apart")

    def pivots(at: DataFrame) -> DataFrame:
        """(bucket, pivot): the most central member of each bucket outside led components."""
        best = F.max(F.struct("central", (-F.col("doc")).alias("last"), "doc", "n", "component")).alias("pivot")
        open_ = at.groupBy("bucket", "component").agg(best, F.bool_or("led").alias("led")).where("NOT led")
        return open_.groupBy("bucket").agg(F.max("pivot").alias("pivot"))

    # First each document meets the most central pivot of its buckets.
    members = members.withColumns({"component": F.col("doc"), "led": F.lit(False)})
    met = members.join(pivots(members), "bucket").where("doc <> pivot.doc").where(_possible("n", "pivot.n", percent))
    first = met.groupBy(F.col("doc").alias("b")).agg(F.max(F.struct("pivot.central", -F.col("pivot.doc"), "pivot.doc"))["doc"].alias("a"))
    links = materialize(confirmed(first), "dedup-links")
    at = still_apart(members, links)
    # Then the members of a mixed bucket meet its most central one, and in the next round the
    # most central one outside the components of those before.
    for _ in range(rounds):
        at = at.join(pivots(at), "bucket", "left")
        asked = at.where("component <> pivot.component").where(_possible("n", "pivot.n", percent))
        more = confirmed(asked.select(F.col("pivot.doc").alias("a"), F.col("doc").alias("b")).distinct())
        links = materialize(links.unionByName(more), "dedup-links")
        led = F.col("led") | F.coalesce(F.col("doc") == F.col("pivot.doc"), F.lit(False))
        at = still_apart(at.withColumn("led", led).drop("pivot"), links)
    top = pivots(at.withColumn("led", F.lit(False)))
    pairs = _candidates(at.join(top, "bucket"), sets, percent, heavy)
    links = materialize(links.unionByName(confirmed(pairs)), "dedup-links")
    # Links between doc_ids again, and those of an id's sets to their representatives.
    extra = classes.where("several").select("node", F.col("doc_id").alias("rep"))
    for end in ("a", "b"):
        links = links.join(extra.withColumnRenamed("node", end), end, "left").withColumn(end, F.coalesce("rep", end)).drop("rep")
    own = named.join(several, "doc_id", "left_semi").join(of_class, "set_key").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    links = links.select("a", "b").unionByName(own.where("a <> b").distinct())
    label = connected_components(links).withColumnRenamed("node", "rep")
    whole = signed.select("doc_id", "n_shingles", "set_key").distinct().join(of_class, "set_key", "left").join(label, "rep", "left")
    found = F.when(F.col("n_shingles") > 0, F.coalesce("component", "rep"))
    return whole.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce(found, "doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def with_sets(pairs: DataFrame, sets: DataFrame, most: int = MOST_PAIRS) -> DataFrame:
    """(a, b, set_a, set_b) of pairs (a, b). Documents ``a`` of more than ``most`` pairs meet them in
    as many parts, each with a copy of the set."""
    pairs = materialize(pairs.select("a", "b"), "dedup-pairs")
    own, other = (sets.select(F.col("doc_id").alias(end), F.col("shingles").alias(f"set_{end}")) for end in ("a", "b"))
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / most).alias("parts")).where("parts > 1")
    parts = materialize(parts.join(own, "a"), "dedup-hot")
    pairs = materialize(pairs.join(parts.select("a", "parts"), "a", "left"), "dedup-dealt")
    copies = parts.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "set_a")
    hot = pairs.where("parts IS NOT NULL").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts"))).join(copies, ["a", "part"])
    rest = pairs.where("parts IS NULL").join(own, "a")
    return hot.select("a", "b", "set_a").unionByName(rest.select("a", "b", "set_a")).join(other, "b").select("a", "b", "set_a", "set_b")


def _candidates(at: DataFrame, sets: DataFrame, percent: int, heavy: int) -> DataFrame:
    """(a, b): the pairs of members with one pivot p and different components that can be linked.

    |a and b| is at most min(|a and p|, |b and p|) and the shingles outside p that both hold,
    and a link needs percent / (100 + percent) of |a| + |b|. One of the two is outside p's
    component. Where the first bound does not suffice, a and b have to share so many shingles
    outside p that, taken from the rarest on, one of the first is among them: such pairs come
    from a join on these shingles. The others come from bands of the members' differences to p where
    neither is linked with p, and from a join on p with the members that are. Shingles outside p that
    more than ``heavy`` members have count as p's; the bounds hold for any set in p's place.
    """
    at = at.select(F.col("pivot.doc").alias("p"), (F.col("component") == F.col("pivot.component")).alias("near_p"), "doc", "n", "component")
    at = materialize(at.distinct(), "dedup-pivots")
    wide = with_sets(at.select(F.col("p").alias("a"), F.col("doc").alias("b")), sets)
    near = wide.mapInArrow(_outside, "doc long, p long, common long, either long, outside array<long>, delta array<long>")
    near = materialize(near.withColumn("linked", F.col("common") * 100 >= F.col("either") * percent), "dedup-outside")
    outer = near.select("doc", "p", F.explode("outside").alias("shingle"))
    held = outer.groupBy("p", "shingle").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    outer = materialize(outer.join(held, ["p", "shingle"]), "dedup-shared")
    moved = outer.groupBy("doc", "p").agg(F.count_if(F.col("holders") > heavy).alias("moved"))
    low = at.groupBy("p").agg(F.min("n").alias("low"))
    at = at.join(near.select("doc", "p", "linked", F.size("delta").alias("differ"), "common", F.size("outside").alias("out")), ["doc", "p"]).join(moved, ["doc", "p"], "left").join(low, "p")
    at = at.withColumn("moved", F.coalesce("moved", F.lit(0))).withColumns({"common": F.col("common") + F.col("moved"), "out": F.col("out") - F.col("moved")})
    # The common shingles that the bound on p's leaves to be found outside p, at least.
    lacking = F.ceil(percent * (F.col("n") + F.col("low")) / (100 + percent)) - F.col("common")
    at = materialize(at.withColumn("lacking", lacking).drop("moved", "low"), "dedup-bounds")
    names = {x: f"{x}_b" for x in ("near_p", "doc", "n", "component", "common", "out")}
    apart = (F.col("component") != F.col("component_b")) & (F.col("near_p_b") | (F.col("doc") < F.col("doc_b")))
    needed = percent * (F.col("n") + F.col("n_b"))
    inside = F.least("common", "common_b")
    enough = at.where("lacking <= 0")
    fits = inside * (100 + percent) >= needed
    # With a member that is linked with p; sets differ by what their differences to p differ at least.
    other = enough.where("linked").select("p", F.col("differ").alias("differ_b"), *[F.col(k).alias(v) for k, v in names.items()])
    close = F.abs(F.col("differ") - F.col("differ_b")) * (100 + percent) <= (100 - percent) * (F.col("n") + F.col("n_b"))
    alone = enough.where("NOT near_p").join(other, "p").where((F.col("component") != F.col("component_b")) & fits & close)
    alike = _alike_differences(enough, near, names, percent).where(fits)
    light = at.join(outer.where(F.col("holders") <= heavy), ["doc", "p"])
    rarest = Window.partitionBy("doc", "p").orderBy("holders", "shingle")
    # ``out`` counts the shingles that nobody shares as well; they stand before all others.
    own = F.col("out") - F.count(F.lit(1)).over(Window.partitionBy("doc", "p"))
    light = light.withColumn("place", F.row_number().over(rarest) + own).where(F.col("place") <= F.col("out") - F.greatest("lacking", F.lit(1)) + 1)
    light = materialize(light.select("p", "shingle", *names), "dedup-light")
    other = light.select("p", "shingle", *[F.col(k).alias(v) for k, v in names.items()])
    reach = (inside + F.least("out", "out_b")) * (100 + percent) >= needed
    outside = light.where("NOT near_p").join(other, ["p", "shingle"]).where(apart & reach)
    pairs = reduce(DataFrame.union, [d.select("doc", "doc_b", "n", "n_b") for d in (alone, alike, outside)])
    return pairs.where(_possible("n", "n_b", percent)).select(F.least("doc", "doc_b").alias("a"), F.greatest("doc", "doc_b").alias("b")).distinct()


def op10_superminhash(spark, sf_dir: str) -> DataFrame:
    """Every document's component under four-word shingles and similarity 0.8."""
    return near_components(table(spark, sf_dir, "documents"), size=4)


OP10_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+'), lambda w: w <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) END AS s
  FROM words
), class AS (
  SELECT min(doc_id) AS rep, count(*) AS copies, list_sort(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)
), member AS (
  SELECT t.doc_id, c.rep FROM sets t JOIN class c ON list_sort(t.s) = c.s
), grams AS (
  SELECT rep, len(s) AS n, hash(unnest(s)) AS g FROM class
), pairs AS (
  SELECT a.rep AS a, b.rep AS b
  FROM grams a JOIN grams b ON a.g = b.g AND a.rep < b.rep AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.rep, b.rep, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), edges AS (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach(node, top) AS (
  SELECT rep, rep FROM class
  UNION
  SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.top
), component AS (
  SELECT node, min(top) AS component FROM reach GROUP BY node
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(c.component, s.doc_id) AS component_id,
       s.doc_id = coalesce(c.component, s.doc_id) AS kept
FROM sets s LEFT JOIN member m ON m.doc_id = s.doc_id LEFT JOIN component c ON c.node = m.rep
"""
