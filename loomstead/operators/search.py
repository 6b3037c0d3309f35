"""Exact cosine top-k for whole batches of queries.

Each task multiplies its Arrow batches of vectors by the query matrix and keeps a running
top-k, so k rows per query and task reach the shuffle. They are merged in two levels, by groups
of tasks first, so that no task gets the rows of all others. Query tables of any size meet the
vectors by cells (``cells``). Documents and metadata never pass through Python: the few winning
ids are joined back to them.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.filters import apply_where, refuse_document_filter
from ..functions.vectors import DISTANCE_DIGITS
from .embedding import embed_documents
from .reads import include_columns

QUERY_INCLUDE = ("metadatas", "documents", "distances")

# Query tables up to this size travel to the tasks as one matrix; larger ones meet the vectors
# cell by cell.
MATRIX_QUERIES = 4096
# Rows of one side that meet in a task of the latter form.
BLOCK_ROWS = 65_536
# Groups of tasks whose best rows are merged before those of all groups are.
MERGE_GROUPS = 256
# Winning rows up to this count may be broadcast when they are joined to their documents.
BROADCAST_HITS = 100_000
# Cells of one distance matrix held at a time.
_CELLS = 4_000_000


def query(
    collection: DataFrame,
    queries: DataFrame,
    n_results: int = 10,
    where=None,
    where_document=None,
    include=None,
    matrix_queries: int = MATRIX_QUERIES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``n_results`` nearest rows of each query (``query_id``, ``embedding``), nearest
    first, ties by id. Rows and queries without a direction (NULL or zero) are left out."""
    refuse_document_filter(where_document)
    columns = include_columns(include, QUERY_INCLUDE)
    rows = apply_where(collection, where)
    queries = queries.select("query_id", "embedding").filter(_has_direction())
    vectors = rows.select("id", "embedding").filter(_has_direction())
    schema = StructType(
        [queries.schema["query_id"], vectors.schema["id"], StructField("distance", DoubleType())]
    )

    block = queries.limit(matrix_queries + 1).toArrow()
    if block.num_rows <= matrix_queries:
        local = vectors.mapInArrow(_TopK(block, n_results).over_batches, schema)
        bounded = block.num_rows * n_results <= BROADCAST_HITS
    else:
        from .cells import nearest_by_cells  # which needs this module

        local = nearest_by_cells(vectors, queries, n_results, block_rows, schema)
        bounded = False

    hits = merged(local, n_results)
    if columns:
        side = F.broadcast(hits) if bounded else hits
        hits = rows.select("id", *columns).join(side, "id")
    shown = ["distance"] if include is None or "distances" in include else []
    return hits.select("query_id", "rank", "id", *shown, *columns)


def query_texts(collection: DataFrame, texts: DataFrame, embedder, **options) -> DataFrame:
    """As :func:`query` for ``texts`` (``query_id``, ``text``), each embedded once."""
    return query(collection, embed_documents(texts, embedder, "text"), **options)


def nested_result(hits: DataFrame) -> DataFrame:
    """One row per query with parallel lists in rank order; each list has at most k entries."""
    payload = [c for c in hits.columns if c not in ("query_id", "rank", "id")]
    packed = F.array_sort(F.collect_list(F.struct("rank", "id", *payload)))
    lists = hits.groupBy("query_id").agg(packed.alias("r"))
    return lists.select(
        "query_id", F.col("r.id").alias("ids"), *[F.col(f"r.{c}").alias(f"{c}s") for c in payload]
    )


def merged(local: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest per query of rows that any number of tasks found, with their rank.

    A query's rows are merged per group of tasks and then over the groups: the first step gets
    k rows of each task of a group, the second at most k x ``MERGE_GROUPS``.
    """
    grouped = local.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
    for keys in (["query_id", "_group"], ["query_id"]):
        nearest = Window.partitionBy(*keys).orderBy("distance", "id")
        grouped = grouped.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)
    return grouped.select("query_id", "id", "distance", "rank")


def _has_direction():
    squares = "aggregate(embedding, 0D, (total, x) -> total + CAST(x AS double) * CAST(x AS double))"
    return F.expr(f"coalesce({squares}, 0D) > 0 AND {squares} < double('infinity')")


def _unit_matrix(column) -> np.ndarray:
    flat = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    width = len(flat[0]) if len(flat) else 0
    matrix = flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), width).astype(np.float64)
    return matrix / np.sqrt(np.einsum("ij,ij->i", matrix, matrix))[:, None]


class _TopK:
    """Nearest rows of a block of queries over a stream of vector batches."""

    def __init__(self, queries: pa.Table, k: int):
        self.queries, self.k = queries, k

    def over_batches(self, batches):
        units = _unit_matrix(self.queries.column("embedding")) if self.queries.num_rows else None
        best = None
        for batch in batches:
            if units is not None and batch.num_rows:
                best = self._merge(best, batch, units)
        if best is not None:
            names = self.queries.column("query_id").combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [names.take(best.column("q")), best.column("id"), best.column("distance")],
                names=["query_id", "id", "distance"],
            )

    def _merge(self, best, batch, units):
        step = max(_CELLS // len(units), 1)
        vectors = batch.column(batch.schema.get_field_index("embedding"))
        widths = pc.list_value_length(vectors)
        if not pc.all(pc.equal(widths, units.shape[1])).as_py():  # such a row has no distance
            batch = batch.filter(pc.equal(widths, units.shape[1]))
            vectors = batch.column(batch.schema.get_field_index("embedding"))
        ids = batch.column(batch.schema.get_field_index("id"))
        for start in range(0, batch.num_rows, step):
            distance = np.round(
                1.0 - _unit_matrix(vectors.slice(start, step)) @ units.T, DISTANCE_DIGITS
            )
            best = self._keep(best, distance, ids.slice(start, step), len(units))
        return best

    def _keep(self, best, distance, ids, n_queries):
        bar = np.full(n_queries, np.inf)  # a row above it cannot be among the k nearest
        if len(distance) > self.k:
            bar = np.partition(distance, self.k - 1, axis=0)[self.k - 1]
        if best is not None:
            bar = np.minimum(bar, self._worst(best, n_queries))
        row, q = np.nonzero(distance <= bar)
        found = pa.RecordBatch.from_arrays(
            [pa.array(q, pa.int64()), ids.take(pa.array(row)), pa.array(distance[row, q])],
            names=["q", "id", "distance"],
        )
        if best is not None:
            found = pa.Table.from_batches([best, found]).combine_chunks().to_batches()[0]
        found = found.take(
            pc.sort_indices(
                found, [("q", "ascending"), ("distance", "ascending"), ("id", "ascending")]
            )
        )
        q = found.column("q").to_numpy()
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        return found.filter(pa.array(rank < self.k))

    def _worst(self, best, n_queries):
        q = best.column("q").to_numpy()
        bar = np.full(n_queries, np.inf)
        full = np.bincount(q, minlength=n_queries) >= self.k
        last = np.searchsorted(q, np.arange(n_queries), side="right") - 1
        bar[full] = best.column("distance").to_numpy()[last[full]]
        return bar
