"""Whole rows as one column, whatever their columns are called."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column name as Spark reads it literally, dots and quotes included."""
    return "`" + name.replace("`", "``") + "`"


def whole_row(df: DataFrame, without: tuple[str, ...] = ()) -> Column:
    """A struct of the row's columns but those named."""
    return F.struct(*[F.col(quoted(c)) for c in df.columns if c not in without])
