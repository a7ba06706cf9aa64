"""Near-duplicate embeddings: exact threshold pairs by dual traversal of cover trees.

Unit vectors with a cosine of at least c are those at a distance of at most
sqrt(2 - 2c), so cosine links are links by distance, for which the triangle inequality
holds. Vectors are only compared within a label (and dimension).

The top level of a label's tree are cells around pivots: chosen farthest-first from a
sample of at most ``PIVOT_ROWS`` vectors, as many as the label fills blocks, up to
``PIVOTS``. *Every* vector goes to its nearest pivot; the sample only decides where cells
lie. Cells larger than a block are split by a hash, so no task gets more than about two
blocks. Cells whose distance exceeds both covering radii and the threshold are not
compared.

For each other pair of blocks, a task builds both cover trees: nested levels with halving
radii, each node a centre and the points within the level's radius that no earlier centre
took. Pairs of nodes are visited from the top: a pair further apart than the two covering
radii and the threshold is dropped; a pair whose farthest points are within the threshold
is counted whole; any other pair is replaced with its children's pairs. Pairs of points are
decided by their cosine in double precision. A task returns, for each of its vectors, the
number of links it found and one edge to its component there, never all pairs.

Identical vectors of a label are compared once, with their number.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component,
and vectors with a null label or id, link with nothing: no links, their own id as
component. Rows with the same id are one vector (the greatest by label and components)
and get the same result. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measure_rollup.llm.components import components
from measure_rollup.llm.samples import sample
from measure_rollup.sources import new_folder

COSINE = 0.93
BLOCK = 2_048
PIVOTS = 64
PIVOT_ROWS = 512
RADII = (1.0, 0.5, 0.25, 0.125)
MARGIN = 1e-6  # of bounds, above the rounding of distances
PAIRS = 200_000  # node pairs looked at at once

_FINITE = (
    "size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x)"
    " and abs(x) < double('Infinity')) and exists(embedding, x -> x <> 0)"
)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows divided by their length, which neither overflows nor vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


class Tree:
    """Levels of nodes over points that are put in order, so that a node is a range of them."""

    def __init__(self, points: np.ndarray, weights: np.ndarray):
        order = np.arange(len(points))
        members = [order]  # of each node, its centre first
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        groups = []
        for radius in RADII:
            finer, children = [], []
            for group in members:
                before = len(finer)
                while len(group):
                    close = np.ones(1, bool)
                    if len(group) > 1:
                        close = _distance(points[group] @ points[group[0]]) <= radius
                        close[0] = True
                    finer.append(group[close])
                    group = group[~close]
                children.append(len(finer) - before)
            groups.append((finer, children))
            members = finer
        self.order = np.concatenate(members) if members else order
        self.points = points[self.order]
        self.weights = weights[self.order]
        self.total = np.concatenate(([0], np.cumsum(self.weights)))
        place = np.empty(len(points), int)
        place[self.order] = np.arange(len(points))
        for level, (nodes, _) in enumerate(groups):
            sizes = np.array([len(node) for node in nodes], int)
            ends = np.cumsum(sizes)
            centres = place[[node[0] for node in nodes]]
            spread = np.array(
                [
                    0.0 if len(node) == 1 else _distance(points[node] @ points[node[0]]).max()
                    for node in nodes
                ]
            )
            below = groups[level + 1][1] if level + 1 < len(groups) else sizes
            self.levels.append((centres, spread, np.stack((ends - sizes, ends)), np.cumsum(below) - below, np.asarray(below)))


def _distance(cosines: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosines, 0))


def merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each that of a smallest point) after points ``a`` and ``b`` are linked."""
    while True:
        x, y = labels[a], labels[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        if (low == high).all():
            return labels
        np.minimum.at(labels, high, low)
        while not np.array_equal(labels, labels[labels]):
            labels = labels[labels]


class Links:
    """Numbers of links and components of the points of two trees (or of one with itself)."""

    def __init__(self, one: Tree, other: Tree, cosine: float):
        self.one, self.other, self.cosine = one, other, cosine
        self.same = one is other
        self.far = float(np.sqrt(2 - 2 * cosine))
        n = len(one.points)
        self.shift = 0 if self.same else n  # of the other's points among all
        self.found = np.zeros(n + 1), np.zeros(len(other.points) + 1)  # differences along the order
        self.labels = np.arange(n if self.same else n + len(other.points))
        self._start()

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        one, other = (np.cumsum(x)[:-1] for x in self.found)
        return (one + other if self.same else one), other

    def _start(self) -> None:
        centres_a, centres_b = self.one.levels[0][0], self.other.levels[0][0]
        step = max(1, PAIRS // max(1, len(centres_b)))
        for at in range(0, len(centres_a), step):
            some = np.arange(at, min(at + step, len(centres_a)))
            far = _distance(self.one.points[centres_a[some]] @ self.other.points[centres_b].T)
            reach = self.one.levels[0][1][some][:, None] + self.other.levels[0][1]
            i, j = np.nonzero(far <= reach + self.far + MARGIN)
            self._visit(0, some[i], j)

    def _visit(self, level: int, i: np.ndarray, j: np.ndarray) -> None:
        if self.same:
            keep = i <= j
            i, j = i[keep], j[keep]
        if level == len(RADII):
            self._decide(i, j)
            return
        centres_a, spread_a, span_a, first_a, below_a = self.one.levels[level]
        centres_b, spread_b, span_b, first_b, below_b = self.other.levels[level]
        for at in range(0, len(i), PAIRS):
            x, y = i[at : at + PAIRS], j[at : at + PAIRS]
            near = np.einsum(
                "ij,ij->i", self.one.points[centres_a[x]], self.other.points[centres_b[y]]
            )
            far = np.where(self.same & (x == y), 0, _distance(near))
            reach = spread_a[x] + spread_b[y]
            # one point each: their own cosine decides
            whole = (far + reach <= self.far - MARGIN) & ~((below_a[x] == 1) & (below_b[y] == 1) & (reach == 0))
            self._take(span_a[:, x[whole]], span_b[:, y[whole]], self.same & (x[whole] == y[whole]))
            open_ = ~whole & (far <= reach + self.far + MARGIN)
            self._open(level, x[open_], y[open_], first_a, below_a, first_b, below_b)

    def _open(self, level, x, y, first_a, below_a, first_b, below_b) -> None:
        """Visit the children's pairs, about ``PAIRS`` at a time."""
        sizes = below_a[x] * below_b[y]
        start, end = 0, np.cumsum(sizes)
        while start < len(x):
            base = end[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(end, base + PAIRS, side="right")))
            part = sizes[start:stop]
            owner = np.repeat(np.arange(start, stop), part)
            inside = np.arange(part.sum()) - np.repeat(np.cumsum(part) - part, part)
            width = below_b[y[owner]]
            self._visit(level + 1, first_a[x[owner]] + inside // width, first_b[y[owner]] + inside % width)
            start = stop

    def _take(self, a: np.ndarray, b: np.ndarray, self_pair: np.ndarray) -> None:
        """Every point of range ``a`` is linked with every point of range ``b``."""
        if not a.shape[1]:
            return
        weight_a = self.one.total[a[1]] - self.one.total[a[0]]
        weight_b = np.where(self_pair, 0, self.other.total[b[1]] - self.other.total[b[0]])
        gain_a = np.where(self_pair, weight_a, weight_b)  # its own weight is taken off at the end
        gain_b = np.where(self_pair, 0, weight_a)
        for found, span, gain in ((self.found[0], a, gain_a), (self.found[1], b, gain_b)):
            np.add.at(found, span[0], gain)
            np.add.at(found, span[1], -gain)
        own = np.concatenate([np.arange(s, e) for s, e in a[:, self_pair].T] or [np.zeros(0, int)])
        np.add.at(self.found[0], own, -self.one.weights[own])
        np.add.at(self.found[0], own + 1, self.one.weights[own])
        for span, shift in ((a, 0), (b, self.shift)):
            joined = np.zeros(len(self.labels) + 1, int)
            np.add.at(joined, span[0] + shift, 1)
            np.add.at(joined, span[1] - 1 + shift, -1)
            inner = np.flatnonzero(np.cumsum(joined)[:-1] > 0)
            self.labels = merge(self.labels, inner, inner + 1)
        self.labels = merge(self.labels, a[0], b[0] + self.shift)

    def _decide(self, i: np.ndarray, j: np.ndarray) -> None:
        """Pairs of points, by their cosine."""
        if self.same:
            keep = i < j
            i, j = i[keep], j[keep]
        for at in range(0, len(i), PAIRS):
            x, y = i[at : at + PAIRS], j[at : at + PAIRS]
            near = np.einsum("ij,ij->i", self.one.points[x], self.other.points[y]) >= self.cosine
            x, y = x[near], y[near]
            for found, at_, gain in (
                (self.found[0], x, self.other.weights[y]),
                (self.found[1], y, self.one.weights[x]),
            ):
                np.add.at(found, at_, gain)
                np.add.at(found, at_ + 1, -gain)
            self.labels = merge(self.labels, x, y + self.shift)


def links_between(
    ids: np.ndarray, second: np.ndarray, vectors: np.ndarray, weights: np.ndarray, same: bool, cosine: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Within one block (``same``) or between two: ids with links, their number, and an id of
    their component. ``second``: whether a row is of the second block.
    """
    if not same and (second.all() or not second.any()):
        return ids[:0], np.zeros(0, np.int64), ids[:0]  # a block without rows
    parts = [np.arange(len(ids))] if same else [np.flatnonzero(~second), np.flatnonzero(second)]
    trees = [Tree(vectors[part], weights[part]) for part in parts]
    found = Links(trees[0], trees[-1], cosine)
    counts = found.counts()
    names = [ids[part][tree.order] for part, tree in zip(parts, trees)]
    if found.same:
        all_ids, number = names[0], counts[0]
    else:
        all_ids, number = np.concatenate(names), np.concatenate(counts)
    linked = np.flatnonzero(np.rint(number) > 0)
    return all_ids[linked], np.rint(number[linked]).astype(np.int64), all_ids[found.labels[linked]]


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows, -1).astype(np.float64)


def _pivots(table: pa.Table) -> pa.Table:
    """Farthest-first pivots of a label's sample."""
    vectors = _matrix(table["unit"], table.num_rows)
    vectors = vectors[np.argsort(table["vec_id"].to_numpy())]
    wanted = min(PIVOTS, len(vectors), -(-table["n"][0].as_py() // BLOCK))
    chosen = [0]
    far = _distance(vectors @ vectors[0])
    while len(chosen) < wanted:
        chosen.append(int(np.argmax(far)))
        far = np.minimum(far, _distance(vectors @ vectors[chosen[-1]]))
    return pa.table(
        {
            "label": [table["label"][0].as_py()],
            "dim": [vectors.shape[1]],
            "pivots": [vectors[chosen].ravel().tolist()],
        },
        schema=pa.schema([("label", pa.int64()), ("dim", pa.int32()), ("pivots", pa.list_(pa.float64()))]),
    )


def _cells(batches):
    for batch in batches:
        cells, far = [], []
        rows = zip(batch["unit"], batch["pivots"])
        known: dict = {}
        for vector, pivots in rows:
            u = vector.values.to_numpy()
            key = pivots.values.to_numpy().tobytes()
            if key not in known:
                known = {key: np.frombuffer(key).reshape(-1, len(u))}
            away = _distance(known[key] @ u)
            cells.append(int(np.argmin(away)))
            far.append(float(away.min()))
        yield pa.RecordBatch.from_arrays(
            [batch["vec_id"], batch["label"], batch["dim"], batch["weight"], batch["unit"]]
            + [pa.array(cells, pa.int32()), pa.array(far, pa.float64())],
            names=["vec_id", "label", "dim", "weight", "unit", "cell", "away"],
        )


def _units(batches):
    for batch in batches:
        lists = batch["embedding"]
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        sizes = batch["dim"].to_numpy()
        ends = np.cumsum(sizes)
        units = [unit(flat[e - n : e][None, :])[0] for e, n in zip(ends, sizes)]
        yield pa.RecordBatch.from_arrays(
            [batch["vec_id"], batch["label"], batch["dim"], batch["weight"]]
            + [pa.array(units, pa.list_(pa.float64()))],
            names=["vec_id", "label", "dim", "weight", "unit"],
        )


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept per row of ``vectors`` (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    usable = rows.filter("vec_id is not null and label is not null").filter(_FINITE)
    by_id = usable.groupBy("vec_id").agg(F.max(F.struct("label", "embedding")).alias("v"))
    by_id = by_id.select("vec_id", "v.label", "v.embedding")
    distinct = by_id.groupBy("label", "embedding").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("weight")
    )
    path = new_folder(spark, "vectors")
    units = "vec_id long, label long, dim int, weight long, unit array<double>"
    (
        distinct.select(
            F.col("rep").alias("vec_id"), "label", F.size("embedding").alias("dim"), "weight", "embedding"
        )
        .mapInArrow(_units, units)
        .write.parquet(f"{path}/units")
    )
    known = spark.read.schema(units).parquet(f"{path}/units")
    sizes = known.groupBy("label", "dim").agg(F.count("*").alias("n"))
    group = F.concat_ws("/", "label", "dim")
    few = sample(
        known.select(F.col("vec_id").alias("doc_id"), "label", "dim", "unit").withColumn("group", group),
        "group",
        PIVOT_ROWS,
    )
    pivots = (
        few.select(F.col("doc_id").alias("vec_id"), "label", "dim", "unit")
        .join(sizes, ["label", "dim"])
        .groupBy("label", "dim")
        .applyInArrow(_pivots, "label long, dim int, pivots array<double>")
    )
    celled = units + ", cell int, away double"
    known.join(pivots, ["label", "dim"]).select("vec_id", "label", "dim", "weight", "unit", "pivots").mapInArrow(
        _cells, celled
    ).write.parquet(f"{path}/cells")
    points = spark.read.schema(celled).parquet(f"{path}/cells")

    keys = ["label", "dim"]
    cells = points.groupBy(*keys, "cell").agg(
        F.max("away").alias("radius"), F.ceil(F.count("*") / block).cast("int").alias("parts")
    )
    centres = pivots.select(
        *keys, F.posexplode(F.expr("transform(sequence(0, cast(size(pivots) / dim as int) - 1),"
        " i -> slice(pivots, i * dim + 1, dim))")).alias("cell", "centre")
    )
    cells = cells.join(centres, [*keys, "cell"])
    left, right = (
        cells.select(*keys, *(F.col(c).alias(f"{c}_{side}") for c in ("cell", "radius", "parts", "centre")))
        for side in "ab"
    )
    apart = F.expr(
        "sqrt(aggregate(zip_with(centre_a, centre_b, (x, y) -> (x - y) * (x - y)), 0D, (s, x) -> s + x))"
    )
    far = float(np.sqrt(2 - 2 * cosine))
    pairs = (
        left.join(right, keys)
        .filter((F.col("cell_a") <= F.col("cell_b")) & (apart <= F.col("radius_a") + F.col("radius_b") + far + MARGIN))
        .select(*keys, "cell_a", "cell_b", F.col("parts_b"), F.explode(F.expr("sequence(0, parts_a - 1)")).alias("part_a"))
        .select(*keys, "cell_a", "cell_b", "part_a", F.explode(F.expr("sequence(0, parts_b - 1)")).alias("part_b"))
        .filter("cell_a < cell_b or part_a <= part_b")
        .withColumn("pair", F.xxhash64(*keys, "cell_a", "part_a", "cell_b", "part_b"))
    )
    same = (F.col("cell_a") == F.col("cell_b")) & (F.col("part_a") == F.col("part_b"))
    first, second = (
        F.struct(F.col(f"cell_{x}").alias("cell"), F.col(f"part_{x}").alias("part"), F.lit(y).alias("second"))
        for x, y in (("a", False), ("b", True))
    )
    sides = (
        pairs.withColumn("same", same)
        .withColumn("side", F.explode(F.when(same, F.array(first)).otherwise(F.array(first, second))))
        .select(*keys, "pair", "same", "side.*")
    )
    parts = cells.select(*keys, "cell", "parts")
    placed = points.join(parts, [*keys, "cell"]).withColumn(
        "part", F.pmod(F.xxhash64("vec_id"), F.col("parts").cast("long")).cast("int")
    )
    grouped = placed.join(sides, [*keys, "cell", "part"]).select(
        *keys, "pair", "same", "second", "vec_id", "weight", "unit"
    )

    def compare(table: pa.Table) -> pa.Table:
        ids, number, roots = links_between(
            table["vec_id"].to_numpy(),
            table["second"].to_numpy(),
            _matrix(table["unit"], table.num_rows),
            table["weight"].to_numpy(),
            table["same"][0].as_py(),
            cosine,
        )
        return pa.table({"vec_id": ids, "n": number, "root": roots})

    grouped.groupBy(*keys, "pair").applyInArrow(compare, "vec_id long, n long, root long").write.parquet(
        f"{path}/links"
    )
    links = spark.read.schema("vec_id long, n long, root long").parquet(f"{path}/links")
    member = components(links.select("vec_id", "root"))
    number = links.groupBy("vec_id").agg(F.sum("n").alias("n"))
    by_rep = (
        distinct.select("label", "embedding", F.col("rep").alias("node"), "weight")
        .join(number.withColumnRenamed("vec_id", "node"), "node", "left")
        .join(member, "node", "left")
        .select(
            "label",
            "embedding",
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    of_id = by_id.join(by_rep, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    return (
        rows.select("vec_id")
        .join(of_id, "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
            F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"),
        )
    )
