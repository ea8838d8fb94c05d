"""Fetching and decoding pages: many at a time within a task, a few tries, and an error row for a page that can't be had."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, IntegerType, StringType, StructField, StructType


class CredentialError(Exception):
    """The store turned the caller away for now; the only error that is tried again."""


def fetched(pages: DataFrame, read: Callable[[str], bytes], decode: Callable[[bytes], bytes] | None = None, uri: str = "uri", concurrency: int = 128, attempts: int = 3, delay: float = 0.5) -> DataFrame:
    """The rows of ``pages`` with content, attempts, error_stage, error_type and error_message.

    ``read`` gets an address and gives bytes, ``decode`` may turn them into others; both run in the Python workers, ``concurrency`` reads at a time in each task.
    A read that raises CredentialError is tried again, after ``delay`` seconds times the number of tries; any other error, or the last, makes an error row of stage
    Fetch or Decode, and all other pages go on. Rows keep their order within a task. A null address is an error of stage Fetch."""
    schema = StructType([*pages.schema.fields, StructField("content", BinaryType()), StructField("attempts", IntegerType()), *(StructField(c, StringType()) for c in ("error_stage", "error_type", "error_message"))])
    arrow = to_arrow_schema(schema)

    def one(address: str | None) -> tuple:
        for k in range(1, attempts + 1):
            try:
                if address is None:
                    raise ValueError("no address")
                data = read(address)
                break
            except CredentialError as e:
                if k == attempts:
                    return None, k, "Fetch", type(e).__name__, str(e)[:512]
                time.sleep(delay * k)
            except Exception as e:
                return None, k, "Fetch", type(e).__name__, str(e)[:512]
        if decode is None:
            return data, k, None, None, None
        try:
            return decode(data), k, None, None, None
        except Exception as e:
            return None, k, "Decode", type(e).__name__, str(e)[:512]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(concurrency) as pool:
            for b in batches:
                for s in range(0, b.num_rows, 4 * concurrency):  # a bounded number of contents is held at a time
                    part = b.slice(s, 4 * concurrency)
                    rows = list(pool.map(one, part.column(uri).to_pylist()))
                    yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(c, t.type) for c, t in zip(zip(*rows), list(arrow)[part.num_columns :]))], schema=arrow)

    return pages.mapInArrow(run, schema)


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(what came, what didn't) of fetched rows."""
    return rows.where("error_stage is null").drop("error_stage", "error_type", "error_message"), rows.where("error_stage is not null").drop("content")


def counted(rows: DataFrame) -> DataFrame:
    """Errors by stage."""
    return rows.where("error_stage is not null").groupBy("error_stage").agg(F.count("*").alias("n"))
