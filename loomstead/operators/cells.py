"""Exact nearest rows for query tables of any size, by cells.

On unit vectors the chord is a metric, and the cosine distance is half its square. Rows belong
to the cell of their nearest pivot. A query first meets the cells around its own pivot that hold
k rows; the k-th distance found there bounds what it still needs. By the triangle inequality it
then visits only the cells that can hold a row within that bound, so nothing is lost. Rows
are not copied: a cell's queries come to it. Crowded cells and crowds of queries are cut into
parts of bounded size.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, IntegerType, StructType

from ..session import written
from .search import _CELLS, _TopK, _unit_matrix, merged

# Pivots, and so cells, at most; their table travels to every task.
PIVOTS = 4096
# What rounding may take off a chord, and off a distance.
CHORD_SLACK, DISTANCE_SLACK = 1e-6, 2e-9
# Pivots nearer to each other than this give no usable plane between them.
LEAST_APART = 1e-3


def chords(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (left @ right.T), 0.0))


class Cells:
    """The pivots, and what is known of the rows of each cell."""

    def __init__(self, pivots: np.ndarray, counts=None, least=None, most=None):
        self.pivots, self.counts, self.least, self.most = pivots, counts, least, most

    def first(self, near: np.ndarray, k: int) -> list[np.ndarray]:
        """Per query (row of chords to the pivots) the nearest cells that hold ``k`` rows together."""
        order = np.argsort(near, axis=1, kind="stable")
        held = np.cumsum(self.counts[order], axis=1)
        enough = np.minimum((held < k).sum(axis=1) + 1, near.shape[1])
        return [cells[:n][self.counts[cells[:n]] > 0] for cells, n in zip(order, enough, strict=True)]

    def others(self, near: np.ndarray, bound: np.ndarray, k: int) -> list[np.ndarray]:
        """Per query the cells that may hold a row within ``bound``, less those it has met first."""
        home = near.argmin(axis=1)
        apart = chords(self.pivots[home], self.pivots)
        plane = near**2 - near[np.arange(len(near)), home][:, None] ** 2
        plane = np.where(apart > LEAST_APART, plane / (2 * np.maximum(apart, LEAST_APART)), 0.0)
        low = np.maximum(np.maximum(near - self.most, self.least - near), plane)
        open_ = (low <= bound[:, None] + CHORD_SLACK) & (self.counts > 0)
        for row, met in zip(open_, self.first(near, k), strict=True):
            row[met] = False
        return [np.flatnonzero(row) for row in open_]


def _units(batch) -> np.ndarray:
    return _unit_matrix(batch.column(batch.schema.get_field_index("embedding")))


def _slices(batch, wide: int):
    """A batch in slices whose table of chords stays small."""
    step = max(_CELLS // wide, 1)
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def _celled(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """The rows with their cell and their chord to its pivot."""

    def run(batches):
        for batch in batches:
            for part in _slices(batch, len(pivots)):
                near = chords(_units(part), pivots)
                cell = near.argmin(axis=1)
                columns = [*part.columns, pa.array(cell.astype(np.int32)), pa.array(near[np.arange(len(near)), cell])]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "cell", "gap"])

    schema = StructType([*vectors.schema.fields]).add("cell", IntegerType()).add("gap", DoubleType())
    return vectors.mapInArrow(run, schema)


def _visits(queries: DataFrame, cells: Cells, k: int) -> DataFrame:
    """One row per query and cell it meets: the first cells, or with a column ``worst`` (the k-th
    distance found in those, NULL for less than k) the others."""
    later = "worst" in queries.columns

    def run(batches):
        for batch in batches:
            for part in _slices(batch, len(cells.pivots)):
                near = chords(_units(part), cells.pivots)
                if later:
                    worst = part.column(part.schema.get_field_index("worst")).to_numpy(zero_copy_only=False)
                    bound = np.where(np.isnan(worst), 2.0, np.sqrt(2 * (np.maximum(worst, 0) + DISTANCE_SLACK)))
                    met = cells.others(near, bound, k)
                else:
                    met = cells.first(near, k)
                at = pa.array(np.repeat(np.arange(len(met)), [len(x) for x in met]))
                cell = np.concatenate([*met, np.zeros(0, np.int64)]).astype(np.int32)
                columns = [part.column(part.schema.get_field_index(n)).take(at) for n in ("query_id", "embedding")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(cell)], names=["query_id", "embedding", "cell"])

    schema = StructType([queries.schema["query_id"], queries.schema["embedding"]]).add("cell", IntegerType())
    return queries.mapInArrow(run, schema)


def _met(rows: DataFrame, visits: DataFrame, counts: np.ndarray, k: int, block_rows: int, schema) -> DataFrame:
    """The k nearest of each visit, per part of its cell."""
    asked = {r["cell"]: r["n"] for r in visits.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    parts = rows.sparkSession.createDataFrame(
        [(c, -(-int(counts[c]) // block_rows), -(-n // block_rows)) for c, n in asked.items()],
        "cell int, row_parts int, query_parts int",
    )
    parts = F.broadcast(parts)  # one row per cell, so at most PIVOTS

    def dealt(df, key, own, other):
        return df.join(parts, "cell").select(
            key, "embedding", "cell",
            F.pmod(F.xxhash64(key), F.col(f"{own}_parts")).cast("int").alias(f"{own}_part"),
            F.explode(F.expr(f"sequence(0, {other}_parts - 1)")).alias(f"{other}_part"),
        )

    kinds = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found = _TopK(right.select(["query_id", "embedding"]), k).over_batches(left.select(["id", "embedding"]).to_batches())
        return pa.Table.from_batches(found, schema=kinds)

    keys = ["cell", "row_part", "query_part"]
    left, right = dealt(rows, "id", "row", "query"), dealt(visits, "query_id", "query", "row")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, schema)


def make_cells(vectors: DataFrame, pivots: int = PIVOTS) -> tuple[DataFrame, Cells]:
    """The rows with their cells (written once), and the summary of the cells."""
    n = vectors.count()
    chosen = vectors.orderBy(F.xxhash64("id"), "id").limit(int(min(max(np.ceil(np.sqrt(n)), 1), pivots)))
    table = chosen.select("embedding").toArrow().combine_chunks()
    units = _units(table.to_batches()[0]) if table.num_rows else np.zeros((0, 1))
    rows = written(_celled(vectors, units))
    counts, least, most = np.zeros(len(units), np.int64), np.zeros(len(units)), np.zeros(len(units))
    summary = rows.groupBy("cell").agg(F.count("*").alias("n"), F.min("gap").alias("least"), F.max("gap").alias("most"))
    for r in summary.collect():
        counts[r["cell"]], least[r["cell"]], most[r["cell"]] = r["n"], r["least"], r["most"]
    return rows, Cells(units, counts, least, most)


def nearest_by_cells(vectors: DataFrame, queries: DataFrame, k: int, block_rows: int, schema, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, id, distance): rows among which are the ``k`` nearest of each query. Rows of
    another width than the queries have no distance."""
    queries = written(queries)  # they are read several times
    asked = queries.select(F.size("embedding").alias("n")).first()
    if asked is None or k < 1:
        return queries.sparkSession.createDataFrame([], schema)
    rows, cells = make_cells(vectors.filter(F.size("embedding") == asked["n"]), pivots)
    if not cells.counts.sum():
        return queries.sparkSession.createDataFrame([], schema)
    first = written(_met(rows, written(_visits(queries, cells, k)), cells.counts, k, block_rows, schema))
    found = merged(first, k).filter(F.col("rank") == k).select("query_id", F.col("distance").alias("worst"))
    again = written(_visits(queries.join(found, "query_id", "left"), cells, k))
    return first.unionByName(_met(rows, again, cells.counts, k, block_rows, schema))
