"""Text helpers made of Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(text, UPPER, LOWER)


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def content_id(text: Column) -> Column:
    """Digest that tells the texts of rows with the same key apart; NULL counts as empty."""
    return F.md5(or_empty(text))
