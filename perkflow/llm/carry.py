"""Rows on their way through an operator: the other columns packed apart from the text.

Operators compute new columns beside whatever columns a table has. The table's
own columns travel as one struct ``row`` and the text as ``t``, so names never
clash and the text, nearly all of the bytes, is held, shuffled and sent to
Python once, and comes back only where the result needs it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def packed(docs: DataFrame, text: str, keep: Sequence[str] | None = None) -> list[Column]:
    """``row`` (the kept columns but the text; default: all) and ``t`` (the text)."""
    others = [F.col(c) for c in (docs.columns if keep is None else keep) if c != text]
    return [F.struct(*(others or [F.lit(0).alias("none")])).alias("row"), F.col(text).alias("t")]


def unpacked(found: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs``, in their order, from ``row`` and ``t``."""
    return found.select(*[F.col("t").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])


def with_text(keep: Sequence[str] | None, text: str) -> bool:
    """Whether the text itself is kept."""
    return keep is None or text in keep
