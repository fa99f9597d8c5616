"""Near-duplicate vectors by a subspace pigeonhole join."""

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tapekeeper.llm.components import components
from tapekeeper.llm.shared import plain, with_groups, written

# Vectors of a cell that one task compares: those at home in it, and those that look in from its neighbourhood.
HOME, LOOK_IN = 4096, 16384

# Rows of the distance matrix, and pairs verified, at a time.
TILE, PAIRS = 256, 1 << 16

# What a block's budget allows for rounding: of the grid, and of distances in single precision.
SLACK, ROUGH = 1e-9, 1e-5


def rotation(size: int, seed: int = 11) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def block_dims(size: int, blocks: int) -> list[np.ndarray]:
    """The dimensions of each block; a block of d of D dimensions has d / D of the squared-distance budget."""
    return np.array_split(np.arange(size), min(blocks, size))


def _rotated(vectors: np.ndarray) -> np.ndarray:
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)) @ rotation(vectors.shape[1])


def placed(classes: DataFrame, limit: float, blocks: int) -> DataFrame:
    """(node, n, vector, block, cells) for each vector and block of its rotated unit vector.

    Of two unit vectors at most sqrt(``limit``) apart, some block is within its share of the budget. A
    grid as wide as that over the block's first two dimensions puts such a pair into the same or
    neighbouring cells. ``cells`` numbers the vector's own cell first, then half of its neighbours, so
    that any two cells meet once. The number holds length, block and both coordinates.
    """
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            sizes, values = np.diff(column.offsets.to_numpy()), column.flatten().to_numpy().astype(np.float64)
            starts = np.cumsum(sizes) - sizes
            for size in np.unique(sizes).tolist():
                rows = np.nonzero(sizes == size)[0]
                turned = _rotated(values[starts[rows][:, None] + np.arange(size)])
                taken = batch.take(pa.array(rows))
                for block, dims in enumerate(block_dims(size, blocks)):
                    width = np.sqrt(limit * len(dims) / size + SLACK)
                    spots = np.floor(turned[:, dims[:2]] / width).astype(np.int64)
                    steps = [s for s in product((-1, 0, 1), repeat=spots.shape[1]) if s >= (0,) * spots.shape[1]]
                    near = (spots[:, None, :] + np.array(steps)) & 0xFFFFF
                    cells = np.full(near.shape[:2], (size & 0xFFFF) << 8 | block, np.int64)
                    for axis in range(near.shape[2]):
                        cells = cells << 20 | near[:, :, axis]
                    ends = np.arange(0, cells.size + 1, cells.shape[1], dtype=np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [*taken.columns, pa.array(np.full(len(rows), block, np.int32)),
                         pa.ListArray.from_arrays(pa.array(ends), pa.array(cells.ravel()))],
                        names=["node", "n", "vector", "block", "cells"])

    rows = classes.select("node", "n", "vector")
    kind = rows.schema["vector"].dataType.simpleString()
    return rows.mapInArrow(place, f"node bigint, n bigint, vector {kind}, block int, cells array<bigint>")


def _join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Gives linked places, and all that share a label with them, the smallest label among them."""
    while True:
        low = np.minimum(label[a], label[b])
        if (label[a] == low).all() and (label[b] == low).all():
            return
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label[:] = label[label]


def compare_cell(home: np.ndarray, look: np.ndarray, block: int, blocks: int, limit: float, threshold: float, allowed):
    """Yields (i, j) of the linked pairs that this block has to answer for.

    Candidates are within the block's budget, found in single precision with room for rounding. A pair
    belongs to the first block whose budget holds it; those of earlier blocks are left out, so
    each pair comes once from all blocks. What remains is verified by its cosine in double precision.
    """
    dims, size = block_dims(home.shape[1], blocks), home.shape[1]
    budgets = [limit * len(d) / size + SLACK / 2 for d in dims]
    y, z = _rotated(home), _rotated(look)
    length, reach = np.linalg.norm(home, axis=1), np.linalg.norm(look, axis=1)
    part, other = y[:, dims[block]].astype(np.float32), z[:, dims[block]].astype(np.float32)
    one = lambda x: np.ones((len(x), 1), np.float32)
    square = lambda x: (x * x).sum(axis=1, keepdims=True)
    left, right = np.hstack([-2 * part, square(part), one(part)]), np.hstack([other, one(other), square(other)]).T
    for first in range(0, len(home), TILE):
        rows, columns = np.nonzero(left[first:first + TILE] @ right <= budgets[block] + ROUGH)
        for at in range(0, len(rows), PAIRS):
            i, j = rows[at:at + PAIRS] + first, columns[at:at + PAIRS]
            mine = allowed(i, j)
            i, j = i[mine], j[mine]
            for number in range(block + 1):
                apart = ((y[i][:, dims[number]] - z[j][:, dims[number]]) ** 2).sum(axis=1)
                fits = apart <= budgets[number] if number == block else apart > budgets[number]
                i, j = i[fits], j[fits]
            cosine = np.einsum("ij,ij->i", home[i], look[j]) / (length[i] * reach[j])
            yield i[cosine >= threshold], j[cosine >= threshold]


def linked(classes: DataFrame, threshold: float, blocks: int) -> DataFrame:
    """What the cells' tasks found, never pair by pair: rows (a, null, others) say that ``others`` rows link with node a
    by the pairs of one task, rows (a, b, null) that a and b are connected.

    A cell with very many vectors is cut into sides, at home and looking in, and every two sides
    meet in a task of their own: tasks stay bounded and no pair is lost.
    """
    limit = 2 * (1 - threshold)
    parts = written(placed(classes, limit, blocks), "placed")
    counted = parts.select(F.posexplode("cells").alias("step", "cell")).groupBy("cell").agg(
        F.count(F.when(F.col("step") == 0, 1)).alias("home"), F.count(F.lit(1)).alias("all"))
    full = counted.select("cell", F.greatest(F.lit(1), F.ceil(F.col("home") / HOME)).alias("homes"),
                          F.ceil(F.col("all") / LOOK_IN).alias("looks")).filter("homes > 1 or looks > 1")
    idle = counted.filter("home = 0 or all = 1").select("cell")  # nobody at home, or nobody else there
    rows = parts.select("node", "n", "vector", "block", F.posexplode("cells").alias("step", "cell"))
    split = rows.join(written(idle, "idle"), "cell", "left_anti").join(written(full, "full"), "cell", "left").fillna(
        1, ["homes", "looks"])
    salt = F.xxhash64("node")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    at_home = split.filter("step = 0").withColumn("h", F.pmod(salt, F.col("homes"))).withColumn("l", every("looks"))
    look_in = split.withColumn("l", F.pmod(salt, F.col("looks"))).withColumn("h", every("homes"))
    columns = ["cell", "h", "l", "node", "n", "vector", "block"]
    met = at_home.select(*columns, F.lit(-1).alias("step")).unionByName(look_in.select(*columns, "step"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        steps, nodes, sizes = group["step"].to_numpy(), group["node"].to_numpy(), group["n"].to_numpy()
        vectors = np.stack(group["vector"].to_numpy()).astype(np.float64)
        at, look = np.nonzero(steps < 0)[0], np.nonzero(steps >= 0)[0]
        own, known = steps[look] == 0, np.unique(nodes)
        place = np.searchsorted(known, nodes)
        label, others = np.arange(len(known)), np.zeros(len(known), np.int64)

        def allowed(i, j):
            a, b = nodes[at[i]], nodes[look[j]]
            return (a != b) & ((a < b) | ~own[j])  # two at home in the same cell meet twice

        if len(at) and len(look):
            for i, j in compare_cell(vectors[at], vectors[look], int(group["block"].iat[0]), blocks, limit, threshold, allowed):
                a, b = place[at[i]], place[look[j]]
                np.add.at(others, a, sizes[look[j]])
                np.add.at(others, b, sizes[at[i]])
                _join_labels(label, a, b)
        some, moved = np.nonzero(others)[0], np.nonzero(label != np.arange(len(known)))[0]
        return pd.DataFrame({
            "a": np.concatenate([known[some], known[moved]]),
            "b": pd.array([*[None] * len(some), *known[label[moved]].tolist()], "Int64"),
            "others": pd.array([*others[some].tolist(), *[None] * len(moved)], "Int64")})

    dealt = met.repartition("cell", "h", "l").groupBy("cell", "h", "l")
    return dealt.applyInPandas(compare, "a bigint, b bigint, others bigint")


def link_vectors(vectors: DataFrame, threshold: float = 0.95, id_column: str = "vec_id", vector_column: str = "embedding",
                 blocks: int = 4) -> DataFrame:
    """(id, n_links, component_id, kept) for every row: the rows within ``threshold`` by cosine, and the smallest id reachable.

    Vectors are taken as they are, whatever other columns say. Null, empty and zero vectors, those with null or
    non-finite components and rows with a null id link with nothing: n_links 0, their own id, kept.
    Vectors of different length never link. Equal vectors are one class, so copies are not expanded into
    pairs; each still counts its copies among its links. ``kept`` marks the row whose id is the
    component's smallest.
    """
    kind = "array<double>" if "double" in dict(vectors.dtypes)[vector_column] else "array<float>"
    raw = vectors.select(plain(id_column).alias("id"), plain(vector_column).cast(kind).alias("vector"))
    big = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    sound = F.col("id").isNotNull() & (F.size("vector") > 0) & F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & (big > 0) & (big < float("inf"))
    marked = raw.select("id", "vector", F.coalesce(sound, F.lit(False)).alias("sound"))
    rows = marked.filter("sound").select("id", "vector", F.sha2(F.array_join(F.col("vector").cast("array<string>"), ","), 256).alias("digest"))
    keyed = written(with_groups(rows.select("id", "digest"), "digest", F.min), "keyed")
    classes = written(rows.groupBy("digest").agg(F.first("vector").alias("vector"), F.min("id").alias("first"),
                                                 F.count(F.lit(1)).alias("n")).withColumn("node", F.monotonically_increasing_id()), "classes")
    found = written(linked(classes, threshold, blocks), "found")
    counts = found.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("others").alias("others"))
    links = found.filter("b is not null").select("a", "b")
    whole = classes.select("node", "digest", "first", "n").join(counts, "node", "left").join(components(links), "node", "left")
    whole = whole.withColumn("component", F.coalesce("component", "node"))
    named = whole.join(whole.groupBy("component").agg(F.min("first").alias("component_id")), "component")
    facts = written(named.select("digest", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"), "facts")
    known = keyed.select("id", "digest").join(facts, "digest").select("id", "n_links", "component_id")
    lone = marked.filter("not sound").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return known.unionByName(lone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
