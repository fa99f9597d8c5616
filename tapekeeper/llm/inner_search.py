"""Exact top-k search by inner product as a Voronoi kNN join."""

from collections.abc import Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tapekeeper.llm.shared import plain, written

# Queries of a group, and data rows of a slice: what one task compares.
GROUP, SLICE = 8192, 4096

# Pivots at most, rows at most from which they are chosen, and rounds of moving them. None of it changes a result.
PIVOTS, LOOKED_AT, ROUNDS = 1024, 8192, 4

# Queries scored at a time.
TILE = 128

# Bits a score may have; vectors whose squared length needs more take no part.
BITS = 62

# What distances in double precision may be off, as a share of the longest.
SLACK = 1e-9

# Rows that share a query's id, up to which the summaries look past them.
OWN = 16


def scaled(vectors: DataFrame, scale: int, id_column: str, vector_column: str) -> DataFrame:
    """(id, size, vector): the components as whole numbers, for rows whose vector can take part."""
    raw = vectors.select(plain(id_column).cast("bigint").alias("id"), plain(vector_column).cast("array<double>").alias("raw"))
    finite = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    square = F.aggregate("raw", F.lit(0.0), lambda s, x: s + (F.abs(x) * scale + 1) * (F.abs(x) * scale + 1))
    sound = F.coalesce(F.when(finite & (F.size("raw") > 0), square < float(1 << BITS)), F.lit(False))
    whole = F.transform("raw", lambda x: F.floor(x * scale))
    return raw.filter(sound).select("id", F.size("raw").alias("size"), whole.alias("vector"))


def _matrix(batch: pa.RecordBatch, name: str, size: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


class Cells(NamedTuple):
    """Pivots of lifted vectors, and what the summaries say of their cells.

    Lifting adds a component that makes all data vectors equally long and is 0 for queries: the nearest
    data vector then is the one with the largest inner product, and distances obey the triangle inequality.
    """

    pivots: np.ndarray    # (cells, size + 1)
    longest: float        # the largest squared length among the data
    nearest: np.ndarray   # (cells, kept): the smallest distances of data rows to their pivot, or infinity
    asked: np.ndarray     # queries per cell
    radius: np.ndarray    # the largest distance of a query to its pivot
    bound: np.ndarray     # no query of the cell needs a data row farther away than this
    skip: int             # data rows to look past: those that may be the query's own

    def lifted(self, vectors: np.ndarray, data: bool) -> np.ndarray:
        extra = np.sqrt(np.maximum(self.longest - (vectors * vectors).sum(axis=1), 0)) if data else np.zeros(len(vectors))
        return np.hstack([vectors, extra[:, None]])

    def distances(self, vectors: np.ndarray, data: bool) -> np.ndarray:
        """From each vector to each pivot."""
        x = self.lifted(vectors.astype(np.float64), data)
        squares = (x * x).sum(axis=1)[:, None] + (self.pivots * self.pivots).sum(axis=1) - 2 * x @ self.pivots.T
        return np.sqrt(np.maximum(squares, 0))

    def slack(self) -> float:
        """Rounding of a distance: a difference of squares may lose half its digits."""
        return 1e-6 * float(np.sqrt(self.longest)) + SLACK

    def kth_bound(self, to_pivots: np.ndarray, k: int) -> np.ndarray:
        """For rows of distances to all pivots: that far away, ``k`` data rows that are not the query's own must lie."""
        reach = (to_pivots[:, :, None] + self.nearest[None]).reshape(len(to_pivots), -1)
        want = k + self.skip
        if self.skip > OWN or reach.shape[1] < want:
            return np.full(len(to_pivots), np.inf)
        return np.partition(reach, want - 1, axis=1)[:, want - 1] + 2 * self.slack()


    def least_score(self, queries: np.ndarray, k: int) -> np.ndarray:
        """For each query a score that its ``k`` best rows surely reach: what its own distances to the pivots allow."""
        values, found = queries.astype(np.float64), []
        for at in range(0, len(values), TILE):
            part = values[at:at + TILE]
            far = self.kth_bound(self.distances(part, False), k) + self.slack()
            found.append(((part * part).sum(axis=1) + self.longest - far * far) / 2 - 1)
        return np.concatenate(found)


def choose_pivots(rows: DataFrame, total: int, size: int, longest: float) -> np.ndarray:
    """Pivots by a few rounds of k-means over a bounded random share of the lifted data."""
    share = rows.select("vector").sample(min(1.0, LOOKED_AT / total), seed=7).limit(LOOKED_AT).toArrow()
    found = share.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    if not len(found):
        return np.zeros((1, size + 1))
    rng = np.random.default_rng(7)
    blank = np.empty(0)
    points = Cells(np.zeros((1, size + 1)), longest, blank, blank, blank, blank, 0).lifted(found.astype(np.float64), True)
    count = min(len(points), max(1, min(PIVOTS, round(total ** 0.5))))
    pivots = points[rng.choice(len(points), count, replace=False)]
    for _ in range(ROUNDS):
        home = ((pivots * pivots).sum(axis=1) - 2 * points @ pivots.T).argmin(axis=1)
        n = np.bincount(home, minlength=len(pivots))
        sums = np.stack([np.bincount(home, points[:, d], len(pivots)) for d in range(size + 1)], axis=1)
        pivots = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], pivots)
    return pivots


def summarise(rows: DataFrame, cells: Cells, kept: int) -> DataFrame:
    """(cell, asks, far, near): per cell of the data the ``kept`` smallest distances, rows with asks null; per cell of the
    queries how many ask and how far the farthest is. A task returns one row per cell and kept distance at most."""
    size, shared = cells.pivots.shape[1] - 1, rows.sparkSession.sparkContext.broadcast(cells)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        near = np.full((len(own.pivots), kept), np.inf)
        asks, far = np.zeros(len(own.pivots), np.int64), np.zeros(len(own.pivots))
        for batch in batches:
            vectors, query = _matrix(batch, "vector", size), batch.column("query").to_numpy(zero_copy_only=False)
            away = own.distances(vectors, True)
            home, least = away.argmin(axis=1), away.min(axis=1)
            for cell in np.unique(home):
                best = np.concatenate([near[cell], least[home == cell]])
                near[cell] = np.sort(np.partition(best, kept - 1)[:kept])
            away = own.distances(vectors[query], False)
            home, least = away.argmin(axis=1), away.min(axis=1)
            np.add.at(asks, home, 1)
            np.maximum.at(far, home, least)
        cell, place = np.nonzero(np.isfinite(near))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell.astype(np.int32)), pa.nulls(len(cell), pa.int64()), pa.nulls(len(cell), pa.float64()),
             pa.array(near[cell, place])], names=["cell", "asks", "far", "near"])
        some = np.nonzero(asks)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(asks[some]), pa.array(far[some]), pa.nulls(len(some), pa.float64())],
            names=["cell", "asks", "far", "near"])

    found = rows.select("vector", "query").mapInArrow(sums, "cell int, asks bigint, far double, near double")
    order = Window.partitionBy("cell").orderBy("near")
    data = found.filter("near is not null").withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= kept)
    queries = found.filter("asks is not null").groupBy("cell").agg(F.sum("asks").alias("asks"), F.max("far").alias("far"))
    return data.select("cell", F.lit(None).cast("bigint").alias("asks"), F.lit(None).cast("double").alias("far"), "near").unionByName(
        queries.select("cell", "asks", "far", F.lit(None).cast("double").alias("near")))


def with_bounds(rows: DataFrame, cells: Cells, k: int) -> Cells:
    """The cells with what the summaries of all rows say, bounded by the number of pivots."""
    kept = k + min(cells.skip, OWN)
    nearest = np.full((len(cells.pivots), kept), np.inf)
    asked, radius = np.zeros(len(cells.pivots), np.int64), np.zeros(len(cells.pivots))
    place = np.zeros(len(cells.pivots), np.int64)
    for cell, asks, far, near in sorted(map(tuple, written(summarise(rows, cells, kept), "summaries").collect()),
                                        key=lambda r: (r[0], r[3] or 0)):
        if asks is None:
            nearest[cell, place[cell]] = near
            place[cell] += 1
        else:
            asked[cell], radius[cell] = asks, far
    cells = cells._replace(nearest=nearest, asked=asked, radius=radius)
    between = np.sqrt(np.maximum(((cells.pivots[:, None] - cells.pivots[None]) ** 2).sum(axis=2), 0)) if len(
        cells.pivots) * cells.pivots.size < 1 << 24 else np.stack([np.linalg.norm(cells.pivots - p, axis=1) for p in cells.pivots])
    bound = np.concatenate([cells.kth_bound(between[i:i + 1] + radius[i], k) for i in range(len(between))])
    return cells._replace(bound=np.where(asked > 0, bound, -np.inf))


def grouped(cells: Cells) -> tuple[np.ndarray, np.ndarray, int]:
    """(first, parts, groups): each cell's first group and over how many its queries are dealt.

    Cells are lined up along the direction in which the pivots differ most, so that a group holds neighbours; a cell
    with more queries than a group takes gets several groups of its own.
    """
    spread = cells.pivots - cells.pivots.mean(axis=0)
    axis = np.linalg.svd(spread, full_matrices=False)[2][0]
    first, parts, group, filled = np.zeros(len(spread), np.int64), np.ones(len(spread), np.int64), 0, 0
    for cell in np.argsort(spread @ axis, kind="stable"):
        n = int(cells.asked[cell])
        if filled and filled + n > GROUP:
            group, filled = group + 1, 0
        first[cell], parts[cell] = group, max(1, ceil(n / GROUP))
        if n > GROUP:
            group, n = group + int(parts[cell]), 0
        filled = filled + n if n else 0 if parts[cell] > 1 else filled
    return first, parts, group + 1


def _dealt(rows: DataFrame, cells: Cells, groups, slices: int) -> tuple[DataFrame, DataFrame]:
    """Data rows (group, slice, id, vector) for each group that needs them, and queries (group, slice, id, cell, vector) for each slice.

    A data row goes to a group if it may lie within the bound of one of its cells. Rows are dealt to slices in turn.
    """
    size, (first, parts, _) = cells.pivots.shape[1] - 1, groups
    shared = rows.sparkSession.sparkContext.broadcast((cells, first, parts))

    def data(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, first, parts = shared.value
        dealt = TaskContext.get().partitionId() * 7919
        asked = np.nonzero(own.asked)[0]
        for batch in batches:
            vectors = _matrix(batch, "vector", size)
            number = (dealt + np.arange(len(vectors))) % slices
            dealt += len(vectors)
            for at in range(0, len(vectors), SLICE):
                near = own.distances(vectors[at:at + SLICE], True)[:, asked] <= (own.radius + own.bound)[asked] + own.slack()
                row, cell = np.nonzero(near)
                cell = asked[cell]
                copies = parts[cell]
                row = np.repeat(row, copies)
                group = np.repeat(first[cell], copies) + np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)
                met = np.unique(np.stack([row, group], axis=1), axis=0) if len(row) else np.empty((0, 2), np.int64)
                taken = batch.slice(at, SLICE).select(["id", "vector"]).take(pa.array(met[:, 0]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(met[:, 1]), pa.array(number[at:at + SLICE][met[:, 0]]), *taken.columns],
                    names=["group", "slice", "id", "vector"])

    def queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, first, parts = shared.value
        dealt = TaskContext.get().partitionId() * 7919
        for batch in batches:
            vectors = _matrix(batch, "vector", size)
            home = own.distances(vectors, False).argmin(axis=1)
            group = first[home] + (dealt + np.arange(len(home))) % parts[home]
            dealt += len(home)
            yield pa.RecordBatch.from_arrays([pa.array(group), batch.column("id"), pa.array(home), batch.column("vector")],
                                             names=["group", "id", "cell", "vector"])

    kind = "id bigint, vector array<bigint>"
    left = rows.select("id", "vector").mapInArrow(data, f"group bigint, slice bigint, {kind}")
    # Of query rows that share an id the largest vector asks.
    asking = written(rows.filter("query").groupBy("id").agg(F.max("vector").alias("vector")), "asking")
    right = asking.mapInArrow(queries, "group bigint, id bigint, cell bigint, vector array<bigint>")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slices - 1).cast("bigint")))
    return left, right.withColumn("slice", every)


def _scores(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Exact inner products: by doubles where no sum can exceed 53 bits, else by whole numbers."""
    most = np.sqrt(float((queries.astype(np.float64) ** 2).sum(axis=1).max()) * float((data.astype(np.float64) ** 2).sum(axis=1).max()))
    if most * 1.001 < 1 << 53:
        return (queries.astype(np.float64) @ data.astype(np.float64).T).astype(np.int64)
    return queries @ data.T


def local_best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, named: np.ndarray, data: np.ndarray, k: int):
    """(query, row) numbers of each query's ``k`` best rows, ties to the smaller id, those without an id last; a query's own
    id is no candidate."""
    order = np.lexsort((ids, ~named))
    ids, named, data = ids[order], named[order], data[order]
    found = []
    for at in range(0, len(queries), TILE):
        scores = _scores(queries[at:at + TILE], data)
        other = ~named | (query_ids[at:at + TILE, None] != ids)
        worst = np.iinfo(np.int64).min
        scores = np.where(other, scores, worst)
        kth = np.partition(scores, max(0, scores.shape[1] - k), axis=1)[:, max(0, scores.shape[1] - k)]
        row, column = np.nonzero((scores >= kth[:, None]) & other)
        best = np.lexsort((column, -scores[row, column], row))
        row, column = row[best], column[best]
        start = np.searchsorted(row, np.arange(len(scores)))
        keep = np.arange(len(row)) - start[row] < k
        row, column = row[keep], column[keep]
        found.append((row + at, order[column], scores[row, column]))
    return [np.concatenate(x) for x in zip(*found)]


def search(vectors: DataFrame, is_query: str, k: int = 10, scale: int = 1024, id_column: str = "vec_id",
           vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its ``k`` rows of highest inner product, all if fewer.

    Components count as floor(``scale`` * x) and scores are exact whole numbers; ties go to the smaller id, rows without one last.
    ``is_query`` is a SQL condition on the column ``id``; rows that share a query's id are its own and no candidates, and of
    several such rows the largest vector asks. Rows whose vector is null or empty, holds null or non-finite components,
    or is longer than 2^31 when scaled take no part; nor does a row without an id ask. Vectors of another
    length are no candidates. Rows that repeat are candidates each. Without queries or candidates there are no rows.

    Queries and data are assigned to the cells of pivots. Summaries of the cells bound how far a cell's
    queries must look; each group of cells gets the data rows within its bounds, in slices of
    bounded size, so neither a cell nor a group is ever gathered whole. What tasks find is merged by query.
    """
    spark = vectors.sparkSession
    rows = written(scaled(vectors, scale, id_column, vector_column).withColumn(
        "query", F.coalesce(F.expr(is_query) & F.col("id").isNotNull(), F.lit(False))), "scaled")
    shape = "query_id bigint, vec_id bigint, score bigint"
    found = [_search_size(rows.filter(F.col("size") == size).select("id", "vector", "query"), size, k, shape)
             for (size,) in sorted(rows.filter("query").select("size").distinct().collect())]
    if not found:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _search_size(rows: DataFrame, size: int, k: int, shape: str) -> DataFrame:
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    total, longest = rows.agg(F.count(F.lit(1)), F.max(square)).first()
    own = rows.filter("query").groupBy("id").count().agg(F.max("count")).first()[0] or 1
    blank = np.empty(0)
    cells = Cells(choose_pivots(rows, total, size, longest), longest, blank, blank, blank, blank, own)
    cells = with_bounds(rows, cells, k)
    groups, slices = grouped(cells), ceil(total / SLICE)
    left, right = _dealt(rows, cells, groups, slices)
    shared = rows.sparkSession.sparkContext.broadcast(cells)

    def solve(data: pa.Table, queries: pa.Table) -> pa.Table:
        known, out = shared.value, [(np.empty(0, np.int64), pa.array([], pa.int64()), np.empty(0, np.int64))]
        if len(data) and len(queries):
            listed = data.column("id").combine_chunks()
            named, ids = ~listed.is_null().to_numpy(zero_copy_only=False), listed.fill_null(0).to_numpy(zero_copy_only=False)
            values = lambda t: t.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            vectors, asking = values(data), values(queries)
            asks, home = queries.column("id").to_numpy(), queries.column("cell").to_numpy()
            away = known.distances(vectors, True)
            for cell in np.unique(home):
                mine = np.nonzero(home == cell)[0]
                near = np.nonzero(away[:, cell] <= known.radius[cell] + known.bound[cell] + known.slack())[0]
                if len(near):
                    q, d, score = local_best(asks[mine], asking[mine], ids[near], named[near], vectors[near], k)
                    enough = score >= known.least_score(asking[mine], k)[q]
                    q, d, score = q[enough], d[enough], score[enough]
                    out.append((asks[mine][q], listed.take(pa.array(near[d])), score))
        return pa.table({"query_id": pa.array(np.concatenate([x[0] for x in out])),
                         "vec_id": pa.concat_arrays([x[1] for x in out]), "score": pa.array(np.concatenate([x[2] for x in out]))})

    return left.groupBy("group", "slice").cogroup(right.groupBy("group", "slice")).applyInArrow(solve, shape)
