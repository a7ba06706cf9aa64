"""Hard negatives by threshold joins over inverted indexes (L2AP).

A row's score with an anchor is the integer inner product of their scaled vectors. An
anchor's positives are its best rows of the same label; for each of them the negatives are
the best rows of other labels whose score lies in a window below the positive's score.
Both are found by threshold joins: all rows that score at least t with an anchor.

The join follows L2AP (Anastasiu and Karypis, 2014). Within a block of rows, dimensions are
in the order of their energy. A row's trailing dimensions are left out of the inverted index
as long as their norm, times an anchor's norm, stays below t: a row that shares no more than
these with the anchor cannot reach t. Rows are in the order of their number of indexed
dimensions, so that the list of every dimension is a leading range of the rows. Partial
scores are accumulated along the lists, a few dimensions at a time, and after each step a
pair is dropped if its partial score and the product of the remaining norms stay below t.
Pairs that are left are completed from the dimensions left out.

Thresholds start high and are lowered, by ``POSITIVE_SHARES`` and ``NEGATIVE_SHARES``, for
the anchors whose windows are not full; the last ones let every row of a window through, so
the result is exact. Within a task the threshold of an anchor also rises to the worst of
the best rows it has found. Rows and anchors are dealt in blocks of bounded size by a hash;
a task holds one block of each and returns the best rows of each window only.

Defined cases: rows with a null id or label, a null vector, or a null or non-finite component
take no part; nor do vectors whose scaled norm is 2^31 or more, whose scores might exceed 64
bits. Rows with the same id are one row, the greatest by label and components. A vector that
is shorter than another counts as filled up with zeros; an empty one is a zero vector. Ties
in score go to the smaller id. Anchors without other rows of their label give no rows, nor do
positives with negative scores, whose windows are empty. Empty tables give empty results.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from measure_rollup.llm.scratch import Scratch
from measure_rollup.sources.shared import settle

BLOCK = 8_192  # rows a task holds
CHUNK = 4_096  # anchors a task holds
SALTS = 64
#: Thresholds of positives, as shares of the largest score that a row of the label might have.
POSITIVE_SHARES = (0.6, 0.25, None)
#: Thresholds of negatives, as shares of the way from a window's lower end to its upper one.
NEGATIVE_SHARES = (0.7, 0.35, 0.0)

QUERIES = 256  # anchors and rows whose partial scores are held at once
TILE = 4_096
STEP = 8  # dimensions accumulated between two rounds of pruning
SPARSE = 1 / 32  # share of pairs from which they are completed one by one
LARGEST = 2**62
SCALE = 256
_FOUND = "anchor_id long, name long, other_id long, score long"


class Windows:
    """The windows of a block of anchors, and the best rows found for each so far."""

    def __init__(self, owner: np.ndarray, low: np.ndarray, high: np.ndarray, size: int, anchors: int):
        self.owner, self.low, self.high, self.size, self.anchors = owner, low.copy(), high, size, anchors
        self.first = np.searchsorted(owner, np.arange(anchors + 1))
        self.window = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.row = np.zeros(0, np.int64)

    def thresholds(self) -> np.ndarray:
        """For each anchor the least score that one of its windows can still use."""
        least = np.full(self.anchors, LARGEST, np.int64)
        np.minimum.at(least, self.owner, self.low)
        return least

    def add(self, anchor: np.ndarray, row: np.ndarray, score: np.ndarray) -> None:
        """Keep the best of these pairs and those kept before; ``row`` is the row's id."""
        found = [(self.window, self.score, self.row)]
        count = np.diff(self.first)[anchor]
        for n in range(int(count.max(initial=0))):
            has = np.flatnonzero(count > n)
            window = self.first[anchor[has]] + n
            fits = (score[has] >= self.low[window]) & (score[has] <= self.high[window])
            found.append((window[fits], score[has][fits], row[has][fits]))
        window, score, row = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((row, -score, window))
        window, score, row = window[order], score[order], row[order]
        rank = np.arange(len(window)) - np.searchsorted(window, window)
        kept = rank < self.size
        self.window, self.score, self.row = window[kept], score[kept], row[kept]
        full = rank == self.size - 1
        self.low[window[full]] = np.maximum(self.low[window[full]], score[full])


class Block:
    """Rows, from which an index is made for each threshold."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        energy = (vectors.astype(np.float64) ** 2).sum(axis=0)
        self.order = np.argsort(-energy, kind="stable")
        self.ids, self.labels, self.vectors = ids, labels, vectors[:, self.order]
        self.ends = [*range(STEP, vectors.shape[1], STEP), vectors.shape[1]]
        self.rest = _rest(self.vectors, self.ends)

    def search(
        self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, windows: Windows, same: bool
    ) -> None:
        """Adds to ``windows`` what it finds; ``same``: rows of the anchor's label, else of others."""
        vectors = vectors[:, self.order]
        rest = _rest(vectors, self.ends)
        norm = rest[:, 0]
        start = windows.thresholds()
        with np.errstate(divide="ignore", invalid="ignore"):
            per_norm = np.where(start <= 0, -np.inf, start / norm)
        by_need = np.argsort(per_norm, kind="stable")
        for at in range(0, len(ids), QUERIES):
            some = by_need[at : at + QUERIES]
            # what a row's omitted dimensions must stay below, for every anchor of these
            least = per_norm[some].min()
            indexed = (self.rest[:, :-1] >= least * (1 - 1e-9)).sum(axis=1)
            rows = np.argsort(-indexed, kind="stable")
            rows = rows[: np.count_nonzero(indexed)]
            for begin in range(0, len(rows), TILE):
                tile = rows[begin : begin + TILE]
                need = windows.thresholds()[some]
                allowed = (self.labels[tile] == labels[some][:, None]) == same
                allowed &= self.ids[tile] != ids[some][:, None]
                q, x, score = self._join(vectors[some], rest[some], need, tile, indexed[tile], allowed)
                if len(q):
                    windows.add(some[q], self.ids[tile[x]], score)

    def _join(self, vectors, rest, need, tile, indexed, alive):
        """Pairs of anchors and rows of ``tile`` with a score of ``need`` or more."""
        rows, rows_rest = self.vectors[tile], self.rest[tile]
        dtype = _dtype(rest[:, 0].max(initial=0) * rows_rest[:, 0].max(initial=0))
        rows_in, anchors_in = rows.astype(dtype), vectors.astype(dtype)
        partial = np.zeros(alive.shape, dtype)
        done = np.zeros(len(tile), int)  # steps accumulated for each row
        begin = 0
        for step, end in enumerate(self.ends):
            listed = int(np.searchsorted(-indexed, -step))  # rows whose index holds this step
            if not listed:
                break
            part = partial[:, :listed]
            part += anchors_in[:, begin:end] @ rows_in[:listed, begin:end].T
            done[:listed] = step + 1
            bound = _bound(rest[:, step + 1][:, None], rows_rest[:listed, step + 1])
            alive[:, :listed] &= part + bound >= need[:, None]
            begin = end
            if np.count_nonzero(alive) < SPARSE * alive.size:
                break
        q, x = np.nonzero(alive)
        score = partial[q, x]
        begin = 0
        for step, end in enumerate(self.ends):
            late = np.flatnonzero(done[x] <= step)
            if len(late):
                more = np.einsum("ij,ij->i", anchors_in[q[late], begin:end], rows_in[x[late], begin:end])
                score[late] += more
                bound = _bound(rest[q[late], step + 1], rows_rest[x[late], step + 1])
                kept = np.ones(len(q), bool)
                kept[late] = score[late] + bound >= need[q[late]]
                q, x, score = q[kept], x[kept], score[kept]
            begin = end
        score = score.astype(np.int64)
        kept = score >= need[q]
        return q[kept], x[kept], score[kept]


def _rest(vectors: np.ndarray, ends: list[int]) -> np.ndarray:
    """Norms of the dimensions from the start, and from the end of each step, on."""
    squares = np.cumsum((vectors.astype(np.float64) ** 2)[:, ::-1], axis=1)[:, ::-1]
    squares = np.concatenate((squares, np.zeros((len(vectors), 1))), axis=1)
    return np.sqrt(squares[:, [0, *ends]])


def _bound(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Product of norms, above its rounding."""
    return (one * other) * (1 + 1e-5) + 1e-3


def _dtype(largest: float) -> type:
    """The fastest type in which scores up to ``largest``, and all partial ones, are exact."""
    if largest < 2**23:
        return np.float32
    return np.float64 if largest < 2**52 else np.int64


def _matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = lists.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    full = np.zeros((len(sizes), width), flat.dtype)
    full[np.arange(width) < sizes[:, None]] = flat
    return full


def _width(table: pa.Table) -> int:
    return int(np.diff(table["vector"].combine_chunks().offsets.to_numpy()).max(initial=0)) if table.num_rows else 0


def _compare(size: int, same: bool):
    def compare(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        width = max(_width(rows), _width(anchors), 1)
        ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        by_id = np.argsort(anchors["vec_id"].to_numpy(), kind="stable")
        anchors = anchors.take(pa.array(by_id))
        low = anchors["low"].combine_chunks()
        owner = np.repeat(np.arange(len(low)), np.diff(low.offsets.to_numpy()))
        windows = Windows(
            owner,
            low.flatten().to_numpy(),
            anchors["high"].combine_chunks().flatten().to_numpy(),
            size,
            len(low),
        )
        anchor_ids = anchors["vec_id"].to_numpy()
        if len(ids) and len(low):
            block = Block(ids, labels, _matrix(rows["vector"], width))
            block.search(
                anchor_ids, anchors["label"].to_numpy(), _matrix(anchors["vector"], width), windows, same
            )
        names = anchors["name"].combine_chunks().flatten().to_numpy()
        return pa.table(
            {
                "anchor_id": anchor_ids[owner[windows.window]],
                "name": names[windows.window],
                "other_id": windows.row,
                "score": windows.score,
            }
        )

    return compare


def scaled(vectors: DataFrame, label: Column | None = None) -> DataFrame:
    """vec_id, label, vector (components times ``SCALE``, rounded down) and norm of the rows that take part."""
    finite = (
        "embedding is not null and forall(embedding, x -> x is not null and not isnan(x)"
        " and abs(x) < double('Infinity'))"
    )
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        (F.col("label") if label is None else label).cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    by_id = (
        rows.filter("vec_id is not null and label is not null")
        .filter(finite)
        .groupBy("vec_id")
        .agg(F.max(F.struct("label", "embedding")).alias("v"))
    )
    floors = by_id.select("vec_id", "v.label", F.expr(f"transform(v.embedding, x -> floor(x * {SCALE}D))").alias("floors"))
    squares = F.expr("aggregate(floors, 0D, (s, x) -> s + double(x) * double(x))")
    return (
        floors.withColumn("norm", F.sqrt(squares))
        .filter(F.col("norm") < 2.0**31)
        .select("vec_id", "label", F.col("floors").cast("array<int>").alias("vector"), "norm")
    )


def _search(rows: DataFrame, anchors: DataFrame, size: int, same: bool, block: int, chunk: int) -> DataFrame:
    """anchor_id, name, other_id, score: the best ``size`` rows of every window.

    ``anchors``: vec_id, label, vector and the arrays name, low and high of its windows. With
    ``same`` an anchor meets the blocks of its label, else all blocks.
    """
    group = F.col("label") if same else F.lit(0).cast("long")
    rows, anchors = rows.withColumn("group", group), anchors.withColumn("group", group)
    if same:
        groups = (
            rows.groupBy("group")
            .agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
            .join(anchors.groupBy("group").agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks")), "group")
        )
        # computed once, for both sides
        groups = settle(groups).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    else:  # one group, whose numbers need no join
        asking = anchors.count()
        numbers = {"blocks": max(1, -(-rows.count() // block)), "chunks": max(1, -(-asking // chunk))}
        rows = rows if asking else rows.limit(0)

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        """With a place among the blocks of its own kind, once for each block of the other."""
        place = F.pmod(F.xxhash64("vec_id", F.lit(own)), F.col(own).cast("long")).cast("int")
        if same:
            salted = df.withColumn("salt", F.pmod(F.xxhash64("vec_id", F.lit("salt")), F.lit(SALTS)).cast("int"))
            numbered = salted.join(groups, ["group", "salt"])
        else:
            numbered = df.withColumns({name: F.lit(number) for name, number in numbers.items()})
        return (
            numbered.withColumn(own[:-1], place)
            .withColumn(other[:-1], F.explode(F.expr(f"sequence(0, {other} - 1)")))
            .drop("salt", "blocks", "chunks")
        )

    keys = ["group", "block", "chunk"]
    row_side = dealt(rows.select("group", "vec_id", "label", "vector"), "blocks", "chunks").groupBy(*keys)
    anchor_side = dealt(
        anchors.select("group", "vec_id", "label", "vector", "name", "low", "high"), "chunks", "blocks"
    ).groupBy(*keys)
    found = row_side.cogroup(anchor_side).applyInArrow(_compare(size, same), _FOUND)
    best = Window.partitionBy("anchor_id", "name").orderBy(F.desc("score"), "other_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= size)


def _fill(
    rows: DataFrame, anchors: DataFrame, windows: DataFrame, size: int, rounds: int, same: bool, scratch: Scratch, **limits
) -> DataFrame:
    """The best rows of every window (anchor_id, name, high, low_0 .. of each round), by lowering thresholds.

    A window that is full at a threshold is done: all rows above it have been seen. At the last
    threshold every window is.
    """
    parts = []
    for n in range(rounds):
        held = windows.groupBy("anchor_id").agg(
            F.collect_list(F.struct("name", F.col(f"low_{n}").alias("low"), "high")).alias("w")
        )
        asking = anchors.join(held, anchors["vec_id"] == held["anchor_id"]).select(
            "vec_id", "label", "vector", "w.name", "w.low", "w.high"
        )
        found = _search(rows, asking, size, same, **limits)
        if n < rounds - 1:
            number = F.count("*").over(Window.partitionBy("anchor_id", "name"))
            found = found.withColumn("n", number).filter(F.col("n") == size).drop("n")
        parts.append(scratch.store(found, f"{'positives' if same else 'negatives'}-{n}"))
        full = parts[-1].filter("rank = 1").select("anchor_id", "name")
        windows = windows.join(full, ["anchor_id", "name"], "left_anti")
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return together


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    block: int = BLOCK,
    chunk: int = CHUNK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``: those of :func:`scaled`. For each anchor and each of its ``positives`` best rows
    of the same label: the ``negatives`` best rows of other labels whose score is from ``low``
    to ``high`` percent of the positive's.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "hard-negatives")
    schema = "vec_id long, label long, vector array<int>, norm double"
    rows = scratch.store(rows.select("vec_id", "label", "vector", "norm"), "rows")
    # a read of its own, as the two sides of a cogroup must not share columns
    anchors = spark.read.schema(schema).parquet(f"{scratch.path}/rows").filter(is_anchor)
    limits = {"block": block, "chunk": chunk}

    longest = rows.groupBy("label").agg(F.max("norm").alias("longest"))
    wanted = (
        anchors.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int"))
        .join(longest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["label", "salt"])
        .select(
            F.col("vec_id").alias("anchor_id"),
            F.lit(0).cast("long").alias("name"),
            F.lit(LARGEST).alias("high"),
            *(
                (F.lit(-LARGEST) if share is None else F.floor(F.col("norm") * F.col("longest") * share))
                .cast("long")
                .alias(f"low_{n}")
                for n, share in enumerate(POSITIVE_SHARES)
            ),
        )
    )
    best = _fill(rows, anchors, wanted, positives, len(POSITIVE_SHARES), True, scratch, **limits)

    score = F.col("score").cast("decimal(24,0)")
    least, most = (F.ceil(score * low / 100).cast("long"), F.floor(score * high / 100).cast("long"))
    windows = (
        best.filter("score >= 0")
        .select("anchor_id", F.col("other_id").alias("name"), least.alias("least"), most.alias("high"))
        .filter("least <= high")
        .select(
            "anchor_id",
            "name",
            "high",
            *(
                (F.col("least") + F.floor((F.col("high") - F.col("least")) * share)).cast("long").alias(f"low_{n}")
                for n, share in enumerate(NEGATIVE_SHARES)
            ),
        )
    )
    found = _fill(rows, anchors, windows, negatives, len(NEGATIVE_SHARES), False, scratch, **limits)
    scores = best.select("anchor_id", F.col("other_id").alias("name"), F.col("score").alias("positive_score"))
    return found.join(scores, ["anchor_id", "name"]).select(
        "anchor_id",
        F.col("name").alias("positive_id"),
        "rank",
        F.col("other_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
