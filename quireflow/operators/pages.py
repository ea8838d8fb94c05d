"""Operators over all rows of a page at once."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def per_page(df: DataFrame, key: str, columns: Sequence[str], f: Callable[[int, list[tuple]], Iterable[tuple]], schema: StructType) -> DataFrame:
    """Applies ``f(key, rows)`` to the rows of each page, in the order of ``columns``.

    Pages become arrays in one shuffle and cross to Python in batches of many pages, so a page costs a function call
    and not a frame of its own. A page must fit in memory, as it does by its nature.
    """
    arrow = to_arrow_schema(schema)
    pages = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("rows"))

    def run(batches):
        for b in batches:
            rows = b.column("rows")
            parts = [c.to_pylist() for c in rows.flatten().flatten()]
            flat, at = list(zip(*parts)), (rows.offsets.to_numpy() - rows.offsets[0].as_py()).tolist()
            out = [r for k, i, j in zip(b.column(key).to_pylist(), at, at[1:]) for r in f(k, flat[i:j])]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t.type) for c, t in zip(zip(*out), arrow)] if out else [pa.array([], type=t.type) for t in arrow], schema=arrow)

    return pages.mapInArrow(run, schema)


def many_pages(df: DataFrame, key: str, columns: Sequence[str], f: Callable[[pa.Array, np.ndarray, list[np.ndarray]], Sequence[pa.Array]], schema: StructType | str) -> DataFrame:
    """As ``per_page``, but ``f(keys, at, columns)`` takes many pages at once, page k with the places from at[k] to at[k + 1] of whole columns of numbers, and returns the columns of
    the result: a row costs no Python object. A null among the numbers is an error."""
    pages = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("rows"))

    def whole(keys, rows):
        return f(keys, rows.offsets.to_numpy() - rows.offsets[0].as_py(), [c.to_numpy() for c in rows.flatten().flatten()])

    return many_rows(pages.select(key, "rows"), whole, schema)


def many_rows(df: DataFrame, f: Callable[..., Sequence[pa.Array]], schema: StructType | str) -> DataFrame:
    """``f`` of the columns of batches of rows, as Arrow arrays; it returns the columns of the result."""
    arrow = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t.type) if not isinstance(c, pa.Array) else c.cast(t.type) for c, t in zip(f(*b.columns), arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def line_accuracy(golden: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """(key, chars, differing, lines, accuracy) of the arrays ``a`` of right lines and ``b`` of lines as they were read: edit distance by line, over the characters of the
    right ones; ``lines`` differ. Lines go together by position; a page with another number of lines is an error. Without a character the accuracy is null."""
    both = golden.join(current, key)
    pairs = F.when(F.size("a") == F.size("b"), F.arrays_zip("a", "b")).otherwise(F.raise_error(F.lit("another number of lines than in the reference")).cast("array<struct<a:string,b:string>>"))
    total = lambda f: F.aggregate("z", F.lit(0).cast("long"), lambda s, p: s + f(p).cast("long"))
    sums = both.select(key, pairs.alias("z")).select(key, total(lambda p: F.length(p["a"])).alias("chars"), total(lambda p: F.levenshtein(p["a"], p["b"])).alias("differing"), total(lambda p: F.when(p["a"] != p["b"], 1).otherwise(0)).alias("lines"))
    return sums.withColumn("accuracy", F.round(1 - F.try_divide("differing", "chars"), 6))
