"""Column references that survive names made from data."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def col(name: str) -> Column:
    """Reference a column whose name may hold dots, slashes or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")
