"""Vector expressions over ``array<double>`` columns and their text form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def norm(vector: Column) -> Column:
    """Euclidean length."""
    return F.sqrt(_total(F.transform(vector, lambda x: x * x)))


def dot(a: Column, b: Column, truncate: bool = False) -> Column:
    """Dot product. Unequal lengths are an error, or with ``truncate`` the longer vector
    is cut to the shorter."""
    if truncate:
        shorter = F.least(F.size(a), F.size(b))
        a, b = F.slice(a, F.lit(1), shorter), F.slice(b, F.lit(1), shorter)
        return _total(F.zip_with(a, b, lambda x, y: x * y))
    product = _total(F.zip_with(a, b, lambda x, y: x * y))
    mismatch = F.raise_error(F.lit("vectors of unequal length")).cast("double")
    return F.when(F.size(a) == F.size(b), product).otherwise(mismatch)


def cosine(dot_product: Column, norm_a: Column, norm_b: Column) -> Column:
    """Cosine from a dot product and two norms; 0 if either vector is all zero."""
    return F.when(
        (norm_a != 0) & (norm_b != 0), dot_product / (norm_a * norm_b)
    ).otherwise(F.lit(0.0))


def parse_vector(csv: Column, strict: bool = False) -> Column:
    """``"x, y, z"`` to doubles. A part that is no number becomes null, or an error; empty
    parts at the end do not count."""
    parts = F.split(F.regexp_replace(csv, r",+\z", ""), ",")
    if strict:
        return F.transform(parts, lambda x: F.trim(x).cast("double"))
    return F.transform(parts, lambda x: F.trim(x).try_cast("double"))


def is_vector(vector: Column) -> Column:
    """True for a non-empty array without nulls."""
    return (
        vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, lambda x: x.isNull())
    )


def format_vector(vector: Column) -> Column:
    return F.array_join(vector.cast("array<string>"), ",")


def format_neighbours(neighbours: Column) -> Column:
    """``array<struct<word, similarity, ...>>`` to ``"w:s w:s"``."""
    shown = F.transform(
        neighbours, lambda n: F.concat(n["word"], F.lit(":"), n["similarity"].cast("string"))
    )
    return F.array_join(shown, " ")


def dense(entries: Column, size: int) -> Column:
    """``array<struct<dim, x>>`` sorted by dim to an array of ``size`` doubles.

    Each entry is preceded by the zeros since the one before it, so the work is linear
    in ``size``.
    """
    zero = F.lit(0.0)

    def gap_and_value(entry, i):
        previous = F.when(i > 0, F.get(entries, i - 1)["dim"]).otherwise(F.lit(-1))
        zeros = F.array_repeat(zero, entry["dim"] - previous - 1)
        return F.concat(zeros, F.array(entry["x"]))

    last = F.coalesce(F.get(entries, F.size(entries) - 1)["dim"], F.lit(-1))
    tail = F.array_repeat(zero, F.lit(size - 1) - last)
    return F.concat(F.flatten(F.transform(entries, gap_and_value)), tail)
