"""Scores of vectors and links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowloom.functions.text import title_tokens


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(vector: Column) -> Column:
    return F.sqrt(dot(vector, vector))


def cosine(left: Column, right: Column, left_norm: Column | None = None, right_norm: Column | None = None) -> Column:
    """Cosine of two vectors; 0 for null, empty, unequal lengths or a zero vector.  Norms that are
    known may be handed over."""
    size = norm(left) if left_norm is None else left_norm
    other = norm(right) if right_norm is None else right_norm
    ok = left.isNotNull() & right.isNotNull() & (F.size(left) == F.size(right)) & (F.size(left) > 0)
    return F.when(ok & (size > 0) & (other > 0), dot(left, right) / (size * other)).otherwise(F.lit(0.0))


def _hits(title: Column, haystack: Column) -> Column:
    return F.size(F.filter(title_tokens(title), lambda t: haystack.contains(t)))


def document_link_score(label: Column, url: Column, title: Column) -> Column:
    """10 for a memory, 6 for a verification, 3 a title word, 1 for a PDF."""
    text = F.lower(F.concat_ws(" ", label, url))
    return (
        F.when(text.contains("memoria"), 10).otherwise(0) + F.when(text.contains("verifica"), 6).otherwise(0)
        + 3 * _hits(title, text) + F.when(F.lower(url).endswith(".pdf"), 1).otherwise(0)
    )


def page_link_score(label: Column, url: Column, title: Column) -> Column:
    """3 for an address of studies, 5 if any title word is hit, 1 for a label of 20 characters."""
    low = F.lower(url)
    return (
        F.when(low.rlike("grado|master|doctorado|estudios"), 3).otherwise(0)
        + F.when(_hits(title, F.concat_ws(" ", F.lower(label), low)) > 0, 5).otherwise(0)
        + F.when(F.length(label) >= 20, 1).otherwise(0)
    )
