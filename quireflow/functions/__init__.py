

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it: Spark doesn't share expressions inside the functions over arrays."""
    return F.get(F.transform(F.array(value), f), F.lit(0))
