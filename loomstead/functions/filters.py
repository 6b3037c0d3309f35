"""Metadata filters: a nested dict of conditions becomes one boolean Column."""

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import PROMOTED


def scalar_text(value) -> str:
    """Filters compare text, so every scalar is spelled the way JSON extraction spells it."""
    if isinstance(value, bool):
        return str(value).lower()
    return str(value)


def _field(key: str, columns) -> Column:
    if key in PROMOTED and key in columns:
        return F.col(key)
    return F.get_json_object("metadata", f"$.{key}")


def _join(conditions, combine):
    conditions = [c for c in conditions if c is not None]
    return reduce(combine, conditions) if conditions else None


def condition(where, columns=()):
    """The Column for ``where``, or None when it holds no condition at all.

    ``columns`` names the columns the frame has; a promoted one is used in place of JSON
    extraction, which Spark can push into the Parquet scan.
    """
    if not where:
        return None
    for word, combine in (("$and", and_), ("$or", or_)):
        if word in where:  # sibling keys are ignored beside a combinator
            return _join([condition(part, columns) for part in where[word]], combine)
    return _join([_leaf(key, value, columns) for key, value in where.items()], and_)


def _leaf(key, value, columns):
    if isinstance(value, dict):
        if "$eq" not in value:
            raise ValueError(f"unsupported operator for {key!r}: {sorted(value)}")
        value = value["$eq"]
    return _field(key, columns) == F.lit(scalar_text(value))


def apply_where(df, where):
    """Rows of ``df`` for which ``where`` is true; a missing key is not a match."""
    found = condition(where, df.columns)
    return df if found is None else df.filter(found)


def refuse_document_filter(where_document):
    if where_document is not None:
        raise NotImplementedError("filtering on document text is not supported")
