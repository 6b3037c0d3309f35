"""Vector columns: array<float> stored, all arithmetic in double."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Distances are rounded here so that copies of one vector tie exactly, whatever order a
# matrix product summed them in; the id then breaks the tie.
DISTANCE_DIGITS = 9


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def dot(a, b) -> Column:
    return _sum(F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")))


def norm(a) -> Column:
    return F.sqrt(_sum(F.transform(_col(a), lambda x: x.cast("double") * x.cast("double"))))


def cosine_distance(a, b) -> Column:
    """1 - cos(a, b), in [0, 2]; NULL where an argument is missing, zero or of another width."""
    scale = norm(a) * norm(b)
    same = F.size(_col(a)) == F.size(_col(b))
    return F.when(
        same & (scale > 0), F.round(1 - dot(a, b) / F.nullif(scale, F.lit(0.0)), DISTANCE_DIGITS)
    )


def scrub(v) -> Column:
    """NaN and infinite components become 0."""
    return F.transform(
        _col(v),
        lambda x: F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0).cast("float")).otherwise(x),
    )


def has_null_component(v) -> Column:
    return F.exists(_col(v), lambda x: x.isNull())


def to_text(v) -> Column:
    """``[a,b,...]``; scrubbed first because JSON has no NaN."""
    return F.to_json(scrub(v))


def from_text(text) -> Column:
    return F.from_json(_col(text), "array<float>")


def unit(v) -> Column:
    """Scale to length 1; a zero vector stays zero."""
    length = norm(v)
    return F.transform(_col(v), lambda x: F.coalesce(F.try_divide(x.cast("double"), length), F.lit(0.0)))


def mean_pool(tokens, mask, dim: int) -> Column:
    """Mean of the token vectors whose mask is set, scaled to length 1.

    ``tokens`` is array<array<float>>, ``mask`` array<int> of the same length.
    """
    tokens, mask = _col(tokens), _col(mask)
    count = F.greatest(_sum(F.transform(mask, lambda m: m.cast("double"))), F.lit(1e-9))
    mean = F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)),
        lambda d: _sum(F.zip_with(tokens, mask, lambda t, m: F.get(t, d).cast("double") * m)) / count,
    )
    return unit(mean)
