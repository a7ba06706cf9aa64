"""Near-duplicate documents by Order MinHash, verified by banded alignment.

Documents are near duplicates if the edit similarity of their words, 1 - distance /
length of the longer, is at least ``SIMILARITY``. Words are lowered and separated by
white space; texts with the same words are exact copies and one class.

Sketches: a document's k-mers are runs of ``K`` words, each labelled with the number of
equal ones before it. Each of ``SKETCHES`` hash functions samples the ``SAMPLED`` smallest
labelled k-mers, which are kept in the order of the text, so that a sketch agrees where
both content and order do. A sketch and a class of length (its borders differ from sketch
to sketch) name a bucket. Two texts without a common bucket are not compared. Of 20,000 pairs
planted at each similarity (15 to 400 words; edits evenly spread, random, insertions, deletions)
7 are lost at 0.8 (most of them in texts of 15 words, 5 of 1,000 with random edits), none at
0.85 and none at 0.9.

Short texts: each text of at most ``SHORT`` words also has a bucket for each text that is left of
it without as many words as its length allows as distance, or fewer (at most 106 of them). Similar
texts have such a rest in common, so no similar pair of short texts is lost.

Verification: every member is first aligned with ``LIKELY`` others, the smallest member of most of
its buckets, which connects most of a group by as many links for each member, whatever its size. That
leaves pairs of members that are not (yet) connected: they are aligned too, each member with the
smallest ones of its other buckets and those likely nearest to it first and then, of what is still
apart, all pairs, block by block of a bucket. Links found later count as links between components,
so no component is searched anew. No pair is aligned whose lengths or word counts
(folded into ``FOLDS`` bins) alone prove it too far apart. What has no possible pair
with a member of another component is compared once only: components only grow together. Links are
verified, so shared passages alone do not link. Groups are the connected components of the links.

No bucket is collected whole: minima are combined before the shuffle, and a bucket of more than
``BLOCK`` members is compared in pairs of blocks of about as many. Blocks of the bucket's largest
component only meet those of its other members, so a large group of near copies is not copied for itself.

Defined cases: null and empty texts have no words; they are one class of exact copies.
Texts of less than five words match their copies only, and one of four its like of five words: a
word is more than 0.2 of them.
Rows without an id are in no group but that of their copies, and are never dropped. Rows
repeated with the same id count once; if an id comes with several texts, one of them
stands for it. Damaged UTF-8 counts as U+FFFD. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from measure_rollup.llm.batches import few_rows
from measure_rollup.llm.components import components
from measure_rollup.llm.scratch import Scratch

SIMILARITY = 0.8
K = 2
SAMPLED = 3
SKETCHES = 96
FOLDS = 1024
COARSE = 128  # bins of a first look at pairs; FOLDS is a multiple of it
LIKELY = 1  # smallest members of buckets that each member is aligned with first
NEAREST = 8  # members that each member is aligned with before all are
BLOCK = 4_096
SLICE = 1 << 20  # pairs of a block that are looked at at once
SHORT = 14  # words of a text for which all rests are named; from 15 on there are 576 and more
LEAST = 12  # words of the shortest text that is similar to one of more than SHORT words
SPAN = 4 * float(np.log(1 / SIMILARITY))  # width of a class of lengths, as a logarithm
MEMORY = 100_000
PART = 1 << 14  # k-mers hashed at once

_rng = np.random.default_rng(20)
_FACTORS = _rng.integers(1, 1 << 63, SKETCHES, dtype=np.uint64) | np.uint64(1)
_SEEDS = _rng.integers(0, 1 << 63, SKETCHES, dtype=np.uint64)
_PLACES = _rng.integers(1, 1 << 63, K + SAMPLED, dtype=np.uint64) | np.uint64(1)
_SHIFTS = np.arange(SKETCHES) / SKETCHES
_SPOTS = _rng.integers(1, 1 << 63, SHORT, dtype=np.uint64) | np.uint64(1)


def words_of(text: str) -> list[str]:
    return text.lower().split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def labelled_kmers(hashes: np.ndarray) -> np.ndarray:
    """A hash of each run of words and of how many equal ones come before it."""
    k = min(K, len(hashes))
    n = len(hashes) - k + 1
    runs = np.zeros(n, np.uint64)
    for place in range(k):
        runs += hashes[place : place + n] * _PLACES[place]
    runs = _mix(runs)
    order = np.argsort(runs, kind="stable")
    ordered = runs[order]
    fresh = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    first = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    before = np.empty(n, np.uint64)
    before[order] = np.arange(n) - first
    return _mix(runs + before * np.uint64(0x9E3779B97F4A7C15))


def sketches(kmers: np.ndarray) -> np.ndarray:
    """A hash of each sketch: the smallest labelled k-mers in the order of the text."""
    taken = min(SAMPLED, len(kmers))
    places = np.empty((SKETCHES, 0), np.int64)
    values = np.empty((SKETCHES, 0), np.uint64)
    for at in range(0, len(kmers), PART):
        part = (kmers[None, at : at + PART] ^ _SEEDS[:, None]) * _FACTORS[:, None]
        few = np.argpartition(part, min(taken, part.shape[1]) - 1, axis=1)[:, :taken]
        places = np.concatenate((places, few + at), axis=1)
        values = np.concatenate((values, np.take_along_axis(part, few, axis=1)), axis=1)
    if places.shape[1] > taken:
        few = np.argpartition(values, taken - 1, axis=1)[:, :taken]
        places = np.take_along_axis(places, few, axis=1)
    found = kmers[np.sort(places, axis=1)]
    total = np.zeros(SKETCHES, np.uint64)
    for i in range(taken):
        total += found[:, i] * _PLACES[K + i]
    return total


@functools.cache
def _rests(size: int) -> list[np.ndarray]:
    """Places of the words that stay when up to the allowed number of ``size`` words is left out."""
    most = int(allowed(size, size))
    return [np.array(list(combinations(range(size), size - out)), np.int64) for out in range(most + 1)]


def rests(hashes: np.ndarray) -> np.ndarray:
    """Hashes of what is left of a short text without some words, each once.

    Of two texts at a distance, a common rest is left of each when it loses the words that the
    alignment changes or takes away: of the longer at most the distance, which its length allows,
    of the shorter as many less as it is shorter, at most what its own length allows.
    """
    spread = _mix(hashes)
    found = [
        _mix((spread[places] * _SPOTS[: places.shape[1]]).sum(axis=1, dtype=np.uint64) + np.uint64(places.shape[1]))
        for places in _rests(len(hashes))
    ]
    return np.unique(np.concatenate(found))


def buckets(hashes: np.ndarray) -> np.ndarray:
    """Names of the buckets of a text with these words' hashes; none without words."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    short = rests(hashes).view(np.int64) if len(hashes) <= SHORT else np.zeros(0, np.int64)
    if len(hashes) < LEAST:  # what is similar to it is short, too
        return short
    sizes = np.floor(np.log(len(hashes)) / SPAN + _SHIFTS).astype(np.uint64)
    names = sketches(labelled_kmers(hashes)) ^ _mix(_SEEDS + sizes)
    return np.concatenate((short, _mix(names).view(np.int64)))


class Hasher:
    """Hashes of words, up to ``MEMORY`` of them kept."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, words: list[str]) -> np.ndarray:
        known = self.known
        missing = set(words).difference(known)
        if missing:
            if len(known) + len(missing) > MEMORY:
                known.clear()
                missing = set(words)
            for word in missing:
                known[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def folded(hashes: np.ndarray) -> bytes:
    """Word counts in ``FOLDS`` bins, at most 255 each."""
    counts = np.bincount((hashes % np.uint64(FOLDS)).astype(np.int64), minlength=FOLDS)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _describe(batches):
    hasher = Hasher()
    for batch in few_rows(batches):
        digests, sizes, names, bins = [], [], [], []
        for text in batch["text"]:
            words = words_of(text.as_py())
            hashes = hasher(words)
            digests.append(hashlib.sha256("\n".join(words).encode("utf-8", "surrogatepass")).digest())
            sizes.append(len(words))
            names.append(buckets(hashes))
            bins.append(folded(hashes))
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                pa.array(digests, pa.binary()),
                pa.array(sizes, pa.int64()),
                pa.array(names, pa.list_(pa.int64())),
                pa.array(bins, pa.binary()),
            ],
            names=["doc_id", "digest", "size", "names", "bins"],
        )


_SKETCHED = "doc_id long, digest binary, size long, names array<long>, bins binary"


def allowed(size_a, size_b, similarity: float = SIMILARITY):
    """The largest distance of texts of these lengths that are similar."""
    return np.floor((1 - similarity) * np.maximum(size_a, size_b) + 1e-9).astype(np.int64)


def least_distance(size_a, bins_a, size_b, bins_b) -> np.ndarray:
    """What lengths and word counts prove the distance to be at least.

    An edit changes the count of one word, or of two in opposite ways, so the distance is
    at least the sum of one side's surplus; folding and capping only lower it.
    """
    surplus = bins_a.astype(np.int16) - bins_b.astype(np.int16)
    more = np.maximum(surplus, 0).sum(axis=-1)
    less = more - surplus.sum(axis=-1)
    return np.maximum(np.abs(size_a - size_b), np.maximum(more, less))


def may_match(size_a, bins_a, size_b, bins_b) -> np.ndarray:
    """False where lengths or word counts prove the distance too large."""
    return least_distance(size_a, bins_a, size_b, bins_b) <= allowed(size_a, size_b)


def _bins(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, FOLDS)


def _only_possible(batches):
    for batch in few_rows(batches):
        keep = may_match(
            batch["size_a"].to_numpy(), _bins(batch["bins_a"]), batch["size_b"].to_numpy(), _bins(batch["bins_b"])
        )
        yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def distance_within(a: list, b: list, limit: int) -> int | None:
    """The edit distance of two sequences if it is at most ``limit``, else None.

    Bit-parallel alignment in a band around the diagonal (Myers; Hyyrö), in integers as wide
    as the band, which is widened step by step.
    """
    if abs(len(a) - len(b)) > limit:
        return None
    start = 0
    shorter = min(len(a), len(b))
    while start < shorter and a[start] == b[start]:
        start += 1
    end = 0
    while end < shorter - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b) if len(b) <= limit else None
    places: dict = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    band = min(limit, 8)
    while True:
        found = _whole(places, len(a), b) if len(a) <= band else _banded(places, len(a), b, band)
        if found <= band:
            return found
        if band >= limit or len(a) <= band:
            return found if found <= limit and len(a) <= band else None
        band = min(limit, 8 * band)


def _whole(places: dict, length: int, b: list) -> int:
    mask, last = (1 << length) - 1, 1 << (length - 1)
    up, down, found = mask, 0, length
    for word in b:
        x = places.get(word, 0)
        zero = ((((x & up) + up) ^ up) | x | down) & mask
        more, less = (down | ~(zero | up)) & mask, zero & up
        found += bool(more & last) - bool(less & last)
        more = more << 1 | 1
        down, up = more & zero & mask, (less << 1 | ~(more | zero)) & mask
    return found


def _banded(places: dict, length: int, b: list, band: int) -> int:
    """The distance, or a number above ``band``. The band moves one row down with each word of ``b``."""
    width = 2 * band + 2
    mask = (1 << width) - 1
    up, down, found = mask ^ ((1 << (width - band - 1)) - 1), 0, band
    top = 1 << (width - 1)
    row = band + 1 - width
    turn = length - band
    # the band's lower edge lies below the last row's end by the band and the lengths' difference
    most = 2 * band + len(b) - length
    for word in b[:turn]:
        x = places.get(word, 0)
        if x:
            x = (x >> row if row >= 0 else x << -row) & mask
        zero = ((((x & up) + up) ^ up) | x | down) & mask
        more, less = (down | ~(zero | up)) & mask, zero & up
        found += not zero & top
        if found > most:
            return found
        up, down = (less | ~((zero >> 1) | more)) & mask, (zero >> 1) & more
        row += 1
    bottom = top >> 1
    for word in b[turn:]:
        x = places.get(word, 0)
        if x:
            x = (x >> row if row >= 0 else x << -row) & mask
        zero = ((((x & up) + up) ^ up) | x | down) & mask
        more, less = (down | ~(zero | up)) & mask, zero & up
        found += bool(more & bottom) - bool(less & bottom)
        bottom >>= 1
        up, down = (less | ~((zero >> 1) | more)) & mask, (zero >> 1) & more
        row += 1
    return found


def _align(batches):
    kept: tuple = (None, None)
    for batch in few_rows(batches):
        a, b, distances = [], [], []
        rows = zip(batch["a"].to_pylist(), batch["b"].to_pylist(), batch["text_a"], batch["text_b"])
        for one, other, text_a, text_b in rows:
            if kept[0] != one:
                kept = (one, words_of(text_a.as_py()))
            words = words_of(text_b.as_py())
            found = distance_within(kept[1], words, int(allowed(len(kept[1]), len(words))))
            if found is not None:
                a.append(one)
                b.append(other)
                distances.append(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(distances, pa.int64())],
            names=["a", "b", "distance"],
        )


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b, distance of the ``pairs`` that are similar."""
    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    other = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    # dealt by pair: one text may be in many pairs, and partitions are not merged by size
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = pairs.join(other, "b").join(one, "a").select("a", "b", "text_a", "text_b")
    return both.repartition(tasks, "a", "b").mapInArrow(_align, "a long, b long, distance long")


def _possible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    one, other = (
        nodes.select(F.col("doc_id").alias(x), F.col("size").alias(f"size_{x}"), F.col("bins").alias(f"bins_{x}"))
        for x in "ab"
    )
    return pairs.join(one, "a").join(other, "b").mapInArrow(_only_possible, "a long, b long")


def _unconnected(nearest: int):
    """Possible pairs of different components, of rows sorted by bucket and pair of blocks.

    All of them, or of each member only the ``nearest`` ones, as the bound has it, and then also every
    member of a bucket that is in a possible pair there: with the bucket's name, and no ``b``.
    ``names`` are all buckets of a member here. A pair is looked at in the first that both have, and
    nowhere else, so that members with many buckets in common are one pair and not one for each.
    """
    columns = ["name", "pair", "second", "same", "doc_id", "component", "size", "names", "bins"]

    def arrays(batch):
        plain = [batch[c].to_numpy(zero_copy_only=False) for c in columns[:-1]]
        return [*plain, _bins(batch["bins"])]

    def found(a, b, name=None) -> pa.RecordBatch:
        none = pa.nulls(len(a), pa.int64())
        names = none if name is None else pa.array(np.full(len(a), name))
        return pa.RecordBatch.from_arrays([names, pa.array(a), none if b is None else pa.array(b)], names=["name", "a", "b"])

    def earlier(of, name) -> np.ndarray:
        """A bit for each bucket before this one that several members here have."""
        sizes = [len(some) for some in of]
        flat = np.concatenate(of)
        row = np.repeat(np.arange(len(of)), sizes)[flat < name]
        _, bit, often = np.unique(flat[flat < name], return_inverse=True, return_counts=True)
        row, bit = row[often[bit] > 1], (np.cumsum(often > 1) - 1)[bit[often[bit] > 1]]
        bits = np.zeros((len(of), int((often > 1).sum()) // 64 + 1), np.uint64)
        np.bitwise_or.at(bits, (row, bit // 64), np.uint64(1) << (bit % 64).astype(np.uint64))
        return bits

    def compare(rows):
        names, _, second, same, ids, component, size, of, bins = rows
        before = earlier(of, names[0])
        one, other = (~second, second) if not same[0] else (slice(None), slice(None))
        coarse = bins.reshape(len(ids), COARSE, -1).sum(axis=2, dtype=np.int16)
        columns = (ids, component, size, before, bins, coarse)
        (ids_a, component_a, size_a, before_a, bins_a, coarse_a), (ids_b, component_b, size_b, before_b, bins_b, coarse_b) = (
            [column[side] for column in columns] for side in (one, other)
        )
        step = max(1, SLICE // max(1, len(ids_b)))
        for start in range(0, len(ids_a), step):  # whole rows, so that each member's nearest are seen
            some = slice(start, start + step)
            near = np.abs(size_a[some, None] - size_b[None, :]) <= allowed(size_a[some, None], size_b[None, :])
            i, j = np.nonzero(near & (component_a[some, None] != component_b[None, :]))
            i += start
            possible = []
            for at in range(0, len(i), 1 << 14):
                x, y = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
                here = ~(before_a[x] & before_b[y]).any(axis=1)
                x, y = x[here], y[here]
                good = may_match(size_a[x], coarse_a[x], size_b[y], coarse_b[y])
                x, y = x[good], y[good]
                least = least_distance(size_a[x], bins_a[x], size_b[y], bins_b[y])
                good = least <= allowed(size_a[x], size_b[y])
                possible.append((x[good], y[good], least[good]))
            if not possible:
                continue
            x, y, least = (np.concatenate(part) for part in zip(*possible))
            if nearest and len(x):
                yield found(np.unique(np.concatenate((ids_a[x], ids_b[y]))), None, names[0])
                order = np.lexsort((ids_b[y], least, x))
                x, y = x[order], y[order]
                near = np.arange(len(x)) - np.searchsorted(x, x) < nearest
                x, y = x[near], y[near]
            a, b = ids_a[x], ids_b[y]
            yield found(*np.unique(np.stack((np.minimum(a, b), np.maximum(a, b))), axis=1))

    def run(batches) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = arrays(batch)
            if waiting is not None:
                rows = [np.concatenate(x) for x in zip(waiting, rows)]
            name, pair = rows[0], rows[1]
            new = (name[1:] != name[:-1]) | (pair[1:] != pair[:-1])
            starts = np.flatnonzero(np.concatenate(([True], new)))
            for s, e in zip(starts[:-1], starts[1:]):
                yield from compare([x[s:e] for x in rows])
            waiting = [x[starts[-1] :] for x in rows]
        if waiting is not None:
            yield from compare(waiting)

    return run


def _rest(rows: DataFrame, nodes: DataFrame, member: DataFrame, nearest: int = 0) -> DataFrame:
    """Possible pairs of bucket members that are not connected yet, as :func:`_unconnected` gives them."""
    known = nodes.join(member, nodes.doc_id == member.node, "left").select(
        "doc_id", "size", "bins", F.coalesce("component", "doc_id").alias("component")
    )
    of = known.select("doc_id", "component")
    rows = rows.filter("n > 2").select("doc_id", "name")  # of two, the only pair was aligned
    mixed = (
        rows.join(of, "doc_id")
        .groupBy("name", "component")
        .agg(F.count("*").alias("n"))
        .groupBy("name")
        .agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("largest"), F.count("*").alias("components"))
        .filter("components > 1")
        .select(
            "name",
            F.col("largest.component").alias("largest"),
            # blocks of the largest component, whose members need not meet each other, and of the others
            F.when(F.col("n") > BLOCK, F.ceil(F.col("largest.n") / BLOCK)).otherwise(0).cast("long").alias("own"),
            F.when(F.col("n") > BLOCK, F.ceil((F.col("n") - F.col("largest.n")) / BLOCK))
            .otherwise(1)
            .cast("long")
            .alias("others"),
        )
    )
    own = (F.col("own") > 0) & (F.col("component") == F.col("largest"))
    place = F.xxhash64("doc_id")
    placed = (
        rows.join(of, "doc_id")
        .join(mixed, "name")
        .withColumn("parts", F.col("own") + F.col("others"))
        .withColumn(
            "part", F.when(own, F.pmod(place, F.col("own"))).otherwise(F.col("own") + F.pmod(place, F.col("others")))
        )
        .withColumn(
            "other",
            F.explode(F.sequence(F.when(own, F.col("own")).otherwise(F.lit(0).cast("long")), F.col("parts") - 1)),
        )
        .select(
            "name",
            (F.least("part", "other") * F.col("parts") + F.greatest("part", "other")).alias("pair"),
            (F.col("part") > F.col("other")).alias("second"),
            (F.col("part") == F.col("other")).alias("same"),
            "doc_id",
        )
    )
    buckets_of = rows.join(mixed.select("name"), "name").groupBy("doc_id").agg(F.collect_set("name").alias("names"))
    # a number is given, so that partitions are not merged by size: few rows are much work here
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.join(known.join(buckets_of, "doc_id"), "doc_id").repartition(tasks, "name", "pair").sortWithinPartitions("name", "pair")
    return dealt.select("name", "pair", "second", "same", "doc_id", "component", "size", "names", "bins").mapInArrow(
        _unconnected(nearest), "name long, a long, b long"
    ).distinct()


def _lifted(pairs: DataFrame, member: DataFrame) -> DataFrame:
    """``pairs`` with the components of both as x and y; who has no links is one of its own."""
    one, other = (member.select(F.col("node").alias(x), F.col("component").alias(y)) for x, y in ("ax", "by"))
    return (
        pairs.join(one, "a", "left")
        .join(other, "b", "left")
        .select("a", "b", F.coalesce("x", "a").alias("x"), F.coalesce("y", "b").alias("y"))
    )


def _apart(pairs: DataFrame, member: DataFrame) -> DataFrame:
    """The ``pairs`` that are not connected."""
    return _lifted(pairs, member).filter("x <> y").select("a", "b")


def _merged(member: DataFrame, more: DataFrame) -> DataFrame:
    """``member`` with ``more`` links, of which those between its components are all that counts."""
    merged = components(_lifted(more, member).select("x", "y"))
    moved = merged.select(F.col("node").alias("component"), F.col("component").alias("now"))
    return (
        member.join(moved, "component", "left")
        .select("node", F.coalesce("now", "component").alias("component"))
        .unionByName(merged.join(member, "node", "left_anti"))
    )


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest id with the same words), group_id, kept per row of ``docs``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "near", few_rows=True)
    stored = scratch.store

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.make_valid_utf8(F.coalesce("text", F.lit(""))).alias("text")
    )
    sketched = stored(texts.mapInArrow(_describe, _SKETCHED), "sketches")
    classes = sketched.groupBy("digest").agg(F.min("doc_id").alias("class_id"))
    nodes = (
        sketched.join(classes, "digest")
        .filter("doc_id = class_id")
        .dropDuplicates(["doc_id"])
        .select("doc_id", "size", "bins", "names")
    )
    named = stored(nodes, "named")
    digests = stored(sketched.select("doc_id", "digest"), "digests")
    scratch.remove("sketches")
    classes = digests.groupBy("digest").agg(F.min("doc_id").alias("class_id"))
    nodes = stored(named.drop("names"), "nodes")
    rows = named.select("doc_id", F.explode("names").alias("name"))
    smallest = rows.groupBy("name").agg(F.min("doc_id").alias("a"), F.count("*").alias("n"))
    shared = stored(rows.join(smallest.filter("n > 1"), "name"), "shared")
    scratch.remove("named")
    first = stored(
        shared.filter("doc_id <> a").groupBy("a", F.col("doc_id").alias("b")).agg(F.count("*").alias("times")), "first"
    )
    # a member that is the smallest in many buckets of another is likely of its group
    place = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("times"), "a"))
    first = first.select("a", "b", (place <= LIKELY).alias("likely"))
    tried = stored(_possible(first.filter("likely").select("a", "b"), nodes), "likely")

    def aligned(pairs: DataFrame, name: str) -> DataFrame:
        # stored, so that Spark knows its size: few ids are broadcast, and no text is shuffled
        needed = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), f"{name}-ids")
        with_text = texts.join(needed, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        return stored(_verified(pairs, with_text), name).select("a", "b")

    member = stored(components(aligned(tried, "links")), "members")
    other = _apart(first.filter("not likely").select("a", "b"), member)
    other = stored(_possible(other, nodes), "other")
    for nearest, name in ((NEAREST, "near"), (0, "rest")):
        # first what is likely to connect; then, of what is still apart, everything
        found = stored(_rest(shared, nodes, member, nearest), f"{name}-found")
        pairs = found.filter("b is not null").select("a", "b")
        if nearest:
            pairs = pairs.unionByName(other)
        pairs = stored(pairs.distinct().join(tried, ["a", "b"], "left_anti"), name)
        if nearest:
            scratch.remove("shared", "first")
        # the others have nothing left to be compared with; two members may be a pair not aligned yet
        shared = found.filter("b is null").select(F.col("a").alias("doc_id"), "name", F.lit(3).cast("long").alias("n"))
        more = aligned(pairs, f"{name}-links")
        if not more.isEmpty():
            member = stored(_merged(member, more), f"{name}-members")
        tried = tried.unionByName(pairs)
    scratch.remove("likely", "other", "nodes")
    groups = classes.join(member, classes.class_id == member.node, "left").select(
        "digest", "class_id", F.coalesce("component", "class_id").alias("group_id")
    )
    return (
        digests.join(groups, "digest")
        .select(
            "doc_id",
            "class_id",
            "group_id",
            F.coalesce(F.col("doc_id") == F.col("group_id"), F.lit(True)).alias("kept"),
        )
    )


def near_dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one document of each group, with all their columns."""
    gone = near_groups(docs).filter(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct()
    rows = docs.select(F.struct("*").alias("row"))  # whose columns may have any names
    kept = rows.join(gone, F.col("row")["doc_id"].cast("long") == F.col("gone"), "left_anti")
    return kept.select("row.*")
