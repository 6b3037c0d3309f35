"""The JSON metadata column: defaults, promoted columns, validity and decoding."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import PROMOTED


def default_metadata(column="metadata") -> Column:
    """Missing metadata (SQL NULL, JSON null, empty text) is an empty object."""
    text = F.trim(F.col(column))
    return F.when(F.col(column).isNull() | text.isin("", "null"), "{}").otherwise(F.col(column))


def is_json_object(column="metadata") -> Column:
    """True for text that parses as one JSON object."""
    c = F.col(column)
    return F.trim(c).startswith("{") & F.get_json_object(c, "$").isNotNull()


def with_promoted(df):
    """(Re)compute the columns kept beside the JSON."""
    return df.withColumns({key: F.get_json_object("metadata", f"$.{key}") for key in PROMOTED})


def metadata_map(column="metadata") -> Column:
    """Decode to map<string,string>; nested values stay JSON text."""
    return F.from_json(column, "map<string,string>")
