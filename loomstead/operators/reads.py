"""Reading a collection: filtered rows, pages, counts and result shapes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.filters import apply_where, refuse_document_filter
from ..functions.metadata import metadata_map
from ..schemas import PROMOTED
from ..session import shared_folder
from ..sources import tables

# Names a caller may ask for, and the column each one stands for.
INCLUDABLE = {"documents": "document", "metadatas": "metadata", "embeddings": "embedding"}
GET_INCLUDE = ("metadatas", "documents")

# Rows that a flat result holds, unless its caller says otherwise.
FLAT_ROWS = 10_000

# Pages that end within so many rows are a top-n.
SHALLOW_PAGE = 100_000


def include_columns(include, default=GET_INCLUDE) -> list[str]:
    wanted = default if include is None else include
    return [column for word, column in INCLUDABLE.items() if word in wanted]


def restrict_ids(df: DataFrame, ids, how="left_semi") -> DataFrame:
    """Rows whose id is (``left_semi``) or is not (``left_anti``) among ``ids``: a list, or a
    frame with an ``id`` column of any size. A NULL among the ids names no row, and a row
    without an id is never among them."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select("id").filter("id IS NOT NULL"), "id", how)
    listed = F.coalesce(F.col("id").isin([i for i in ids if i is not None]), F.lit(False))
    return df.filter(listed if how == "left_semi" else ~listed)


def _given(ids) -> bool:
    return ids is not None and (isinstance(ids, DataFrame) or len(ids) > 0)


def get(
    collection: DataFrame,
    ids=None,
    where=None,
    where_document=None,
    include=None,
    limit=None,
    offset=None,
) -> DataFrame:
    """Rows matching all of ids and ``where``; an empty id list means no id condition.

    With ``limit`` or ``offset`` the rows are taken in id order.
    """
    refuse_document_filter(where_document)
    rows = apply_where(collection, where)
    if _given(ids):
        rows = restrict_ids(rows, ids)
    rows = rows.select("id", *include_columns(include))
    if limit is None and offset is None:
        return rows
    return page(rows, limit, offset or 0)


def page(rows: DataFrame, limit=None, offset: int = 0) -> DataFrame:
    """``limit`` rows in id order after skipping ``offset``.

    A small page near the start is a top-n. Otherwise the ids are sorted once into a snapshot of
    their own, which knows the place of each of its files; the ids at the page's ends are read off
    it and become a filter. Many pages of the same rows are better read from a stored snapshot
    (``tables.write_sorted``, ``tables.read_page``).
    """
    if limit is not None and offset + limit <= SHALLOW_PAGE:
        return rows.orderBy("id").offset(offset).limit(limit)
    if limit is None and not offset:
        return rows.orderBy("id")
    spark, root, ids = rows.sparkSession, shared_folder(rows.sparkSession), rows.select("id")
    tables.write_sorted(ids, root)
    paged = tables.read_page(spark, root, ids.schema, limit, offset)
    ends = paged.agg(F.min("id").alias("low"), F.max("id").alias("high")).first()
    if ends["low"] is None:
        return rows.filter(F.lit(False))
    low, high = F.lit(ends["low"]), F.lit(ends["high"])
    within, at_ends = F.col("id").between(low, high), F.col("id").isin(low, high)
    every, own = (
        dict(x.filter(at_ends).groupBy("id").count().collect())
        for x in (tables.read_snapshot(spark, root, ids.schema)[1], paged)
    )
    if every == own:
        return rows.filter(within).orderBy("id")
    # Rows that share an id: as many of them as are within the page.
    page_rows = rows.filter(within & ~at_ends)
    for end, n in own.items():
        page_rows = page_rows.unionByName(rows.filter(F.col("id") == end).limit(n))
    return page_rows.orderBy("id")


def flat_result(rows: DataFrame, include=None, limit: int = FLAT_ROWS) -> DataFrame:
    """One row of parallel lists, of the first ``limit`` rows in id order."""
    columns = include_columns(include)
    rows = rows.orderBy("id").limit(limit)
    packed = F.array_sort(F.collect_list(F.struct("id", *columns)))
    lists = rows.agg(packed.alias("r"))
    return lists.select(
        F.col("r.id").alias("ids"), *[F.col(f"r.{c}").alias(f"{c}s") for c in columns]
    )


def count(collection: DataFrame) -> DataFrame:
    return collection.agg(F.count("*").alias("n"))


def count_by(collection: DataFrame, field: str, where=None) -> DataFrame:
    """Rows per value of a promoted column; rows without one count as "unknown"."""
    if field not in PROMOTED:
        raise ValueError(f"cannot count by {field!r}; choose one of {PROMOTED}")
    return _counted(collection, where, field)


def count_tree(collection: DataFrame, where=None) -> DataFrame:
    """Rows per wing and room."""
    return _counted(collection, where, "wing", "room")


def _counted(collection, where, *fields):
    named = [F.coalesce(F.col(f), F.lit("unknown")).alias(f) for f in fields]
    return apply_where(collection, where).groupBy(*named).agg(F.count("*").alias("n"))


def decoded_metadata(collection: DataFrame) -> DataFrame:
    """Rows with the metadata as a map in place of its JSON text."""
    return collection.withColumn("metadata", metadata_map())
