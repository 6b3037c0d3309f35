"""Name normalisation for entities and predicates; ``c`` is a column name or SQL expression."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def predicate_slug(c: str) -> Column:
    return F.expr(f"replace(lower({c}), ' ', '_')")


def entity_slug(c: str) -> Column:
    """Like a predicate, with apostrophes removed as well."""
    return F.expr(f"replace(replace(lower({c}), ' ', '_'), '\\'', '')")


def slug_of(name: str) -> str:
    return predicate_of(name).replace("'", "")


def predicate_of(name: str) -> str:
    return name.lower().replace(" ", "_")


def capitalized(c: str) -> str:
    """SQL text: first character upper, the rest lower."""
    return f"concat(upper(substring({c}, 1, 1)), lower(substring({c}, 2)))"


def capitalize(c: str) -> Column:
    return F.expr(capitalized(c))
