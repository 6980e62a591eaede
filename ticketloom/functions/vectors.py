"""Dense vectors as arrays, plus their text form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def vector_text(v: Column) -> Column:
    """``[a,b,c]``"""
    return F.concat(F.lit("["), F.array_join(F.transform(v, lambda x: x.cast("string")), ","), F.lit("]"))


def parse_vector(text: Column, element: str = "float") -> Column:
    return F.from_json(text, f"array<{element}>")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cos, from 0 (same direction) to 2; NULL when a vector is all zero."""
    return F.lit(1.0) - F.try_divide(dot(a, b), norm(a) * norm(b))


def similarity_score(distance: Column) -> Column:
    """1 at distance 0, 0 at distance 2."""
    return F.lit(1.0) - distance / F.lit(2.0)


def max_distance(similarity: float) -> float:
    return (1.0 - similarity) * 2.0


def arg_max_label(probabilities: Column, labels: list[str]) -> Column:
    """Label at the first largest probability."""
    position = F.array_position(probabilities, F.array_max(probabilities)).cast("int")
    return F.element_at(F.array(*[F.lit(x) for x in labels]), position)
