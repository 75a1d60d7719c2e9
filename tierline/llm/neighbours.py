"""Approximate nearest neighbours: stable projections in kd-trees, with a chi-square stop.

Every vector is projected to a few dimensions by Gaussian directions, which are
2-stable: the squared projected distance over the squared true distance follows a
chi-square distribution with as many degrees of freedom. A kd-tree over projected
points yields them by increasing projected distance; each is verified by its true
distance, and the search of a query ends once the next projected distance exceeds what
a point as near as the worst kept one would show with probability ``confidence``.

The tree has two levels. Its upper part cuts the projected space into cells: it is
fitted on a bounded sample of ``SAMPLE_ROWS`` projected vectors for each of at most
``MAX_CELLS`` cells, and every vector is then assigned to its cell, so all are indexed. The
lower part is a tree over the vectors of one cell, built in the task that holds them.
A query first searches the nearest cells that hold enough vectors, which bounds the
distance of its last neighbour; then it visits only those other cells whose box of projected
points lies within the stopping distance of that bound. Cells of more than
``block_rows`` vectors, and the queries of a cell beyond ``query_rows``, are dealt
to several tasks, so a task holds a bounded block of either.

``n_verified`` tells how many vectors a query was compared with. Nothing is pruned where
the nearest vectors are hardly nearer than all others.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite
components, take no part, neither as query nor as candidate; vectors of different
lengths have no distance, so each length is searched by itself; a
query with fewer candidates gets all, and one with none gives no row; ties go to the smaller id; a query's own row is
never its neighbour, and rows with one id are that same vector repeated, of which one
(the smallest by its components) is kept; null ids take no part, and ids that are no
integers are an error; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tierline.llm.common import read_table, stored

DIMENSIONS = 24
CONFIDENCE = 0.93
LEAF = 64
BLOCK_ROWS = 2_048
QUERY_ROWS = 4_096
MAX_CELLS = 4_096
SAMPLE_ROWS = 16  # for each cell


def chi_square_quantile(p: float, k: int) -> float:
    """The value that a chi-square variable with ``k`` degrees of freedom stays below with probability ``p``."""

    def below(x: float) -> float:  # the regularised lower incomplete gamma function as a power series
        a, x = k / 2, x / 2
        term = total = 1 / a
        n = a
        while term > total * 1e-15:
            n += 1
            term *= x / n
            total += term
        return total * math.exp(-x + a * math.log(x) - math.lgamma(a)) if x > 0 else 0.0

    low, high = 0.0, float(k)
    while below(high) < p:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


class KdTree:
    """Leaves of at most ``leaf`` points, cut at the median of the widest side; boxes are those of the points."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        self._low, self._high, self._nodes = [], [], []  # corners; children or None, range in order
        stack = [(0, len(points), -1, 0)]
        while stack:
            start, stop, parent, side = stack.pop()
            own = points[self.order[start:stop]]
            low, high = own.min(axis=0), own.max(axis=0)
            node = len(self._nodes)
            self._low.append(low)
            self._high.append(high)
            self._nodes.append(([-1, -1] if stop - start > leaf else None, start, stop))
            if parent >= 0:
                self._nodes[parent][0][side] = node
            if stop - start > leaf:
                middle = (stop - start) // 2
                cut = np.argpartition(own[:, int(np.argmax(high - low))], middle)
                self.order[start:stop] = self.order[start:stop][cut]
                stack += [(start, start + middle, node, 0), (start + middle, stop, node, 1)]
        self._low, self._high, self._points = np.array(self._low), np.array(self._high), points[self.order]

    def nearest_first(self, point: np.ndarray, limit: Callable[[], float]) -> Iterator[np.ndarray]:
        """Points by increasing squared distance from ``point`` up to ``limit()``, which may shrink meanwhile.

        A point's turn comes when it is nearer than every box not yet opened; points are handed out in growing chunks.
        """
        gaps = _gaps(self._low, self._high, point).tolist()
        heap = [(gaps[0], 0)]
        members, far, least = [], [], math.inf  # points waiting for their turn
        while heap and heap[0][0] <= limit():
            children, start, stop = self._nodes[heapq.heappop(heap)[1]]
            if children is not None:
                for c in children:
                    heapq.heappush(heap, (gaps[c], c))
                continue
            members.append(self.order[start:stop])
            far.append(((self._points[start:stop] - point) ** 2).sum(axis=1))
            least = min(least, float(far[-1].min()))
            edge = heap[0][0] if heap else math.inf
            if least <= edge:
                waiting, d = np.concatenate(members), np.concatenate(far)
                ready = d <= edge
                yield from _chunks(waiting[ready], d[ready], limit)
                members, far = [waiting[~ready]], [d[~ready]]
                least = float(far[0].min(initial=math.inf))
        if members:
            yield from _chunks(np.concatenate(members), np.concatenate(far), limit)


def _gaps(low: np.ndarray, high: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Squared distances of boxes from a point."""
    return (np.maximum(np.maximum(low - point, point - high), 0.0) ** 2).sum(axis=1)


def _chunks(members: np.ndarray, far: np.ndarray, limit: Callable[[], float], size: int = 32) -> Iterator[np.ndarray]:
    order = np.argsort(far, kind="stable")
    members, far = members[order], far[order]
    at = 0
    while at < (stop := min(at + size, int(np.searchsorted(far, limit(), "right")))):
        yield members[at:stop]
        at, size = stop, 2 * size


class Cells:
    """The upper tree: the projected space of one length cut at medians of a sample; a cell is the number of its node."""

    def __init__(self, sample: np.ndarray, cells: int):
        self._axis, self._cut, self._below, self._above = [], [], [], []
        stack = [(sample, cells, -1, self._below)]
        while stack:
            own, wanted, parent, side = stack.pop()
            node = len(self._axis)
            if parent >= 0:
                side[parent] = node
            spread = np.ptp(own, axis=0) if len(own) else np.zeros(1)
            axis = int(np.argmax(spread)) if wanted > 1 and spread.max() > 0 else -1
            cut = 0.0
            if axis >= 0:  # the largest value below the upper half, or below the maximum where that is most
                values = np.sort(own[:, axis])
                cut = float(values[len(values) // 2 - 1])
                if cut == values[-1]:
                    cut = float(values[values < cut][-1])
            for column, value in ((self._axis, axis), (self._cut, cut), (self._below, -1), (self._above, -1)):
                column.append(value)
            if axis >= 0:
                below = own[:, axis] <= cut
                stack += [(own[below], wanted // 2, node, self._below), (own[~below], wanted - wanted // 2, node, self._above)]
        self._axis, self._cut = np.array(self._axis), np.array(self._cut)
        self._below, self._above = np.array(self._below), np.array(self._above)

    def of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        while len(open_ := np.flatnonzero(self._axis[node] >= 0)):
            n = node[open_]
            below = points[open_, self._axis[n]] <= self._cut[n]
            node[open_] = np.where(below, self._below[n], self._above[n])
        return node


@dataclass
class Index:
    """What tasks know of the whole: directions, the cells of long lengths and their boxes.

    ``cells``, ``boxes`` (cell numbers, low and high corners, sizes) have the lengths of more than ``cell_rows`` vectors; any other length is one cell, -1.
    """

    dimensions: int
    seed: int
    threshold: float
    scale: float
    cell_rows: int
    cells: dict[int, Cells] = field(default_factory=dict)
    boxes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)
    _axes: dict[int, np.ndarray] = field(default_factory=dict)

    def project(self, vectors: np.ndarray) -> np.ndarray:
        """Scaled first: huge or tiny components don't overflow a square."""
        length = vectors.shape[1]
        if length not in self._axes:
            self._axes.clear()  # one length at a time, as lengths may be many
            self._axes[length] = np.random.default_rng(self.seed).standard_normal((length, self.dimensions))
        return (vectors / self.scale) @ self._axes[length]

    def limit(self, bound: float, slack: float) -> float:
        """The squared projected distance at which a search stops."""
        return self.threshold * (bound / self.scale) ** 2 * (1 + 1e-9) + slack

    @staticmethod
    def slack(projected: np.ndarray) -> float:
        """By how much equal vectors may differ, by rounding."""
        return 1e-24 * (1 + float((projected**2).sum()))

    def cell(self, vectors: np.ndarray) -> np.ndarray:
        length = vectors.shape[1]
        return self.cells[length].of(self.project(vectors)) if length in self.cells else np.full(len(vectors), -1)

    def visits(self, query: np.ndarray, bound: float | None, k: int) -> np.ndarray:
        """Cells of a query: with no bound yet, the nearest that hold more than ``k`` vectors; with one, all others within it."""
        length = len(query)
        if length not in self.boxes:
            return np.array([-1] if bound is None else [], np.int64)
        cells, low, high, sizes = self.boxes[length]
        projected = self.project(query[None])[0]
        gaps = _gaps(low, high, projected)
        order = np.lexsort((cells, gaps))
        first = int(np.searchsorted(np.cumsum(sizes[order]), k + 1)) + 1
        if bound is None:
            return cells[order[:first]]
        rest = order[first:]
        return cells[rest[gaps[rest] <= self.limit(bound, self.slack(projected))]]


def search_block(
    q_ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray, ids: np.ndarray, vectors: np.ndarray, *, k: int, index: Index
) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """For each query its nearest found in one block, none beyond its bound: id, neighbours' ids and distances, number of vectors verified."""
    tree = KdTree(index.project(vectors))
    for q_id, query, bound, projected in zip(q_ids, queries, bounds, index.project(queries), strict=True):
        kept_d, kept_i, verified, slack = np.empty(0), np.empty(0, np.int64), 0, index.slack(projected)
        worst = float(bound)  # no farther vector is wanted
        for members in tree.nearest_first(projected, lambda: index.limit(worst, slack)):  # noqa: B023
            members = members[ids[members] != q_id]
            verified += len(members)
            d = np.sqrt(((vectors[members] - query) ** 2).sum(axis=1))
            if not (near := d <= worst).any():
                continue
            kept_d, kept_i = np.concatenate([kept_d, d[near]]), np.concatenate([kept_i, ids[members[near]]])
            best = np.lexsort((kept_i, kept_d))[:k]
            kept_d, kept_i = kept_d[best], kept_i[best]
            if len(kept_d) == k:
                worst = min(worst, float(kept_d[-1]))
        yield int(q_id), kept_i, kept_d, verified


def clean_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id``, ``v`` (array of double): usable vectors, one per id."""
    v = F.col("v")
    usable = (
        F.col("id").isNotNull()
        & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(v, lambda x: x != 0)
    )
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.coalesce(usable, F.lit(False))).groupBy("id").agg(F.min("v").alias("v"))
    return stored(rows, "vectors")


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The rows of each length of ``v``, with their vectors as a matrix."""
    lengths = pc.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        own = batch.take(pa.array(np.flatnonzero(lengths == length)))
        yield own, _matrix(own.column("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _mapped(df: DataFrame, schema: str, rows: Callable[[pa.RecordBatch, np.ndarray], list | None]) -> DataFrame:
    """``rows`` (columns for the vectors of one length) of every batch of ``df``."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, matrix in _by_length(batch):
                columns = rows(own, matrix)
                if columns is not None and len(columns[0]):
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(run, schema)


def build_index(vectors: DataFrame, *, block_rows: int, dimensions: int, confidence: float, seed: int) -> Index:
    """Cells fitted on a bounded sample, their boxes and sizes from every vector."""
    n, scale = vectors.agg(F.count("*"), F.max(F.array_max(F.transform("v", F.abs)))).first()
    cell_rows = max(block_rows, -(-n // MAX_CELLS))
    index = Index(dimensions, seed, chi_square_quantile(confidence, dimensions), scale or 1.0, cell_rows)
    # At most n / cell_rows lengths, so no more than MAX_CELLS.
    lengths = {r[0]: r[1] for r in vectors.groupBy(F.size("v")).count().where(F.col("count") > cell_rows).collect()}
    if not lengths:
        return index
    long = vectors.where(F.size("v").isin(list(lengths)))
    share = SAMPLE_ROWS / cell_rows  # so about SAMPLE_ROWS for each cell
    drawn = long.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)))
    project = lambda own, m: [pa.array([m.shape[1]] * len(m), pa.int32()), pa.array(index.project(m).tolist(), pa.list_(pa.float64()))]
    points: dict[int, list] = {length: [] for length in lengths}
    for length, point in _mapped(drawn, "length int, point array<double>", project).collect():
        points[length].append(point)
    for length, size in lengths.items():
        sample = np.array(sorted(points[length])).reshape(-1, dimensions)
        index.cells[length] = Cells(sample, -(-size // cell_rows))

    def boxes(own: pa.RecordBatch, matrix: np.ndarray) -> list:
        at, cell = index.project(matrix), index.cell(matrix)
        found = np.unique(cell)
        parts = [at[cell == c] for c in found]
        corners = [pa.array([f(p, axis=0).tolist() for p in parts], pa.list_(pa.float64())) for f in (np.min, np.max)]
        sizes = pa.array([len(p) for p in parts], pa.int64())
        return [pa.array([matrix.shape[1]] * len(found), pa.int32()), pa.array(found, pa.int32()), sizes, *corners]

    parts = _mapped(long, "length int, cell int, n bigint, low array<double>, high array<double>", boxes)
    low = [F.min(F.col("low")[i]) for i in range(dimensions)]
    high = [F.max(F.col("high")[i]) for i in range(dimensions)]
    whole = parts.groupBy("length", "cell").agg(F.sum("n").alias("n"), F.array(*low).alias("low"), F.array(*high).alias("high"))
    # At most two cells for each share of cell_rows vectors.
    rows = whole.orderBy("length", "cell").collect()
    for length in lengths:
        own = [r for r in rows if r.length == length]
        index.boxes[length] = (
            np.array([r.cell for r in own]), np.array([r.low for r in own]), np.array([r.high for r in own]), np.array([r.n for r in own]),
        )
    return index


FOUND = "query_id bigint, vec_id bigint, score double, verified bigint"


def _search(vectors: DataFrame, asked: DataFrame, index: Index, first: bool, *, k: int, block_rows: int, query_rows: int) -> DataFrame:
    """What ``asked`` (id, v and, unless ``first``, bound) finds in the cells it visits; a row without vec_id where a block gave none."""
    slices = {(length, c): -(-n // block_rows) for length, (cells, _, _, sizes) in index.boxes.items() for c, n in zip(cells.tolist(), sizes.tolist(), strict=True)}
    small = -(-index.cell_rows // block_rows)  # a length that is one cell has no more vectors or queries than cell_rows
    small_groups = -(-index.cell_rows // query_rows)

    def visit(own: pa.RecordBatch, matrix: np.ndarray) -> list | None:
        bounds = np.full(len(matrix), np.inf) if first else own.column("bound").to_numpy(zero_copy_only=False)
        cells = [index.visits(q, None if first else b, k) for q, b in zip(matrix, bounds, strict=True)]
        row = np.repeat(np.arange(len(matrix)), [len(c) for c in cells])
        if not len(row):
            return None
        cell, length = np.concatenate(cells), matrix.shape[1]
        of = pa.array([slices.get((length, c), small) for c in cell.tolist()], pa.int32())
        taken = own.take(pa.array(row))
        return [taken.column("id"), taken.column("v"), pa.array(bounds[row]), pa.array([length] * len(row), pa.int32()), pa.array(cell, pa.int32()), of]

    key = ["length", "cell", "slice", "part"]
    visits = stored(_mapped(asked, "id bigint, v array<double>, bound double, length int, cell int, slices int", visit), "visits")
    crowded = visits.where("cell >= 0").groupBy("length", "cell").count().where(F.col("count") > query_rows).collect()  # of MAX_CELLS
    groups = {(r.length, r.cell): -(-r["count"] // query_rows) for r in crowded}

    def place(own: pa.RecordBatch, matrix: np.ndarray) -> list:
        cell, length = index.cell(matrix), matrix.shape[1]
        of = np.array([slices.get((length, c), small) for c in cell.tolist()])
        parts = pa.array([groups.get((length, c), small_groups if c < 0 else 1) for c in cell.tolist()], pa.int32())
        at = own.column("h").to_numpy(zero_copy_only=False) % of
        return [own.column("id"), own.column("v"), pa.array([length] * len(cell), pa.int32()), pa.array(cell, pa.int32()), pa.array(at, pa.int32()), parts]

    hashed = vectors.withColumn("h", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 40)))
    placed = _mapped(hashed, "id bigint, v array<double>, length int, cell int, slice int, parts int", place)
    left = placed.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")

    def grouped(own: pa.RecordBatch, matrix: np.ndarray) -> list:
        length = matrix.shape[1]
        of = np.array([groups.get((length, c), small_groups if c < 0 else 1) for c in own.column("cell").to_pylist()])
        part = pa.array(own.column("h").to_numpy(zero_copy_only=False) % of, pa.int32())
        return [*(own.column(c) for c in ("id", "v", "bound", "length", "cell", "slices")), part]

    dealt = visits.withColumn("h", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1 << 40)))
    dealt = _mapped(dealt, "id bigint, v array<double>, bound double, length int, cell int, slices int, part int", grouped)
    right = dealt.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices")

    def search(_: tuple, own: pa.Table, ask: pa.Table) -> pa.Table:
        columns: list[list] = [[], [], [], []]
        if own.num_rows and ask.num_rows:
            own, ask = own.combine_chunks(), ask.combine_chunks()
            found = search_block(
                ask["id"].to_numpy(), _matrix(ask["v"].chunk(0)), ask["bound"].to_numpy(),
                own["id"].to_numpy(), _matrix(own["v"].chunk(0)), k=k, index=index,
            )
            for q, ids, distances, verified in found:
                n = max(1, len(ids))
                columns[0] += [q] * n
                columns[1] += ids.tolist() or [None]
                columns[2] += distances.tolist() or [None]
                columns[3] += [verified] + [0] * (n - 1)
        types = (pa.int64(), pa.int64(), pa.float64(), pa.int64())
        names = [c.split()[0] for c in FOUND.split(", ")]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return stored(left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(search, FOUND), "found")


def nearest(
    df: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_where=None,
    k: int = 10,
    dimensions: int = DIMENSIONS,
    confidence: float = CONFIDENCE,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
    seed: int = 7,
) -> DataFrame:
    """The ``k`` nearest found of each query: query_id, rank (from 1), vec_id, score (Euclidean distance), n_verified.

    Queries are the rows of ``df`` whose id meets ``query_where`` (a function of the id column).
    """
    vectors = clean_vectors(df, id_col, vector_col)
    index = build_index(vectors, block_rows=block_rows, dimensions=dimensions, confidence=confidence, seed=seed)
    asked = vectors.where(query_where(F.col("id"))) if query_where is not None else vectors
    sizes = {"k": k, "block_rows": block_rows, "query_rows": query_rows}
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    best = lambda found: found.where("vec_id is not null").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    found = _search(vectors, asked, index, True, **sizes)
    last = best(found).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("bound"))
    bounded = asked.join(last, "id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    if index.boxes:
        found = found.unionByName(_search(vectors, bounded, index, False, **sizes))
    verified = found.groupBy("query_id").agg(F.sum("verified").alias("n_verified"))
    return best(found).drop("verified").join(verified, "query_id").select("query_id", "rank", "vec_id", "score", "n_verified")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), query_where=lambda i: i % 100 == 0)
