"""Shared plumbing: the checkpoint folder, plain column selection and packed shuffles."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, IntegralType, StructField, StructType


PART_BYTES, MOST_PARTS = 128 << 20, 1 << 17
_MADE: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir. Where that is unset, a local one is made if Spark runs in one process; on a cluster it is an error."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if given:
        if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
            spark.sparkContext.setCheckpointDir(given)
        return given.rstrip("/")
    at = spark.sparkContext._jsc.sc().getCheckpointDir()
    if at.isEmpty():
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quireflow-"))
        at = spark.sparkContext._jsc.sc().getCheckpointDir()
    return str(at.get()).rstrip("/")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, noted for ``release``."""
    _MADE.append(path := f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return path


def made() -> int:
    """How many scratch paths there are so far."""
    return len(_MADE)


def release(spark: SparkSession, since: int, keep: tuple[str, ...] = ()) -> None:
    """Deletes the scratch tables made since there were so many, for when what was computed from them is written. Files of checkpoints are
    Spark's to delete (spark.cleaner.referenceTracking.cleanCheckpoints)."""
    for path in _MADE[since:]:
        if path not in keep:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    _MADE[since:] = [p for p in _MADE[since:] if p in keep]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def col(df: DataFrame, name: str) -> Column:
    """A column by its plain name, whatever signs are in it."""
    return df[f"`{name}`"]


def key_of(df: DataFrame, id_col: str) -> Column:
    """The 64-bit key of an id: a whole number itself, the hash of an id of any other type. ``named`` turns keys into ids again."""
    c = col(df, id_col)
    return c.cast("long") if isinstance(df.schema[id_col].dataType, IntegralType) else F.when(c.isNotNull(), F.xxhash64(c))


def named(out: DataFrame, df: DataFrame, id_col: str, *columns: str) -> DataFrame:
    """``out`` with ids in place of their keys in these columns. Whole numbers are their own keys; else each column costs a join with the ids. Where two ids
    share a hash, of which there is a chance of one in 200 among 10^9, the lesser stands for both."""
    if isinstance(df.schema[id_col].dataType, IntegralType):
        return out
    names = df.select(key_of(df, id_col).alias("_key"), col(df, id_col).alias("_name")).where("_key is not null").groupBy("_key").agg(F.min("_name").alias("_name"))
    for c in columns:
        own = names.withColumnRenamed("_key", c)
        out = out.join(own, c, "left").select(*[F.col("_name").alias(c) if x == c else F.col(x) for x in out.columns])
    return out


def id_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns id (the key of the id) and text alone, so no other column of the caller can clash. Rows without an id are left out."""
    return df.select(key_of(df, id_col).alias("id"), col(df, text_col).cast("string").alias("text")).where("id is not null")


def partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def tidy(f: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's function that gives memory back to the system at its end: Python workers wait for more work with what they have."""

    @functools.wraps(f)
    def run(batches):
        try:
            yield from f(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
            if trim:
                trim(0)

    return run


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) if not isinstance(c, (pa.Array, pa.ChunkedArray)) else c for c, f in zip(columns, schema)], schema=schema)


def packed(part: np.ndarray, record: np.ndarray, n: int) -> Iterator[tuple[int, bytes]]:
    """Splits fixed-width records by target partition into one blob each: a row costs its bytes, no more."""
    order = np.argsort(part.astype(np.uint16 if n <= 1 << 16 else np.uint32), kind="stable")
    record = record[order]
    bound = np.searchsorted(part[order], np.arange(n + 1))
    for p in np.flatnonzero(np.diff(bound)):
        yield int(p), record[bound[p] : bound[p + 1]].tobytes()


PACKED = "part int, blob binary"
PACKED_ARROW = pa.schema([("part", pa.int32()), ("blob", pa.binary())])


def packed_batches(part: np.ndarray, record: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
    rows = list(packed(part, record, n))
    if rows:
        yield batch(PACKED_ARROW, [p for p, _ in rows], [b for _, b in rows])


def by_part(df: DataFrame, n: int) -> DataFrame:
    """Brings the blobs of a part together: part k is partition k, so that no two parts share one."""
    return df.repartitionById(n, "part")


def parts_for(df: DataFrame, size: int) -> int:
    """Partitions for a shuffle of so many bytes: those the session sets, more if they would hold over ``PART_BYTES`` each. A task holds its partition in memory."""
    return max(partitions(df), min(MOST_PARTS, -(-int(size) // PART_BYTES)))


def planned_bytes(df: DataFrame) -> int:
    """The size of ``df`` by Spark's statistics, for which nothing runs: that of the files of a scan; 0 where it isn't known."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 54 else 0


def unpack(batches, dtype: np.dtype) -> np.ndarray:
    """All records of this partition."""
    blobs = [v.as_buffer() for b in batches for v in b.column("blob") if v.is_valid]
    return np.concatenate([np.frombuffer(x, dtype) for x in blobs]) if blobs else np.zeros(0, dtype)


def text_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns id, of its own type, and text; every row stays, also those without an id."""
    return df.select(col(df, id_col).alias("id"), col(df, text_col).cast("string").alias("text"))


def row_schemas(docs: DataFrame, columns: list[tuple[str, DataType]]) -> tuple[StructType, pa.Schema]:
    """The id of ``docs`` and more columns, for Spark and for Arrow."""
    schema = StructType([StructField("id", docs.schema["id"].dataType), *(StructField(n, t) for n, t in columns)])
    return schema, to_arrow_schema(schema)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage with a table in the shared folder: it is columnar and compressed, and is computed once."""
    at = scratch(df.sparkSession, name)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def filter_rows(df: DataFrame, column: str, kept: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """The rows of ``df`` for whose texts ``kept`` says so: one pass, no join, all columns as they are, whatever their names."""
    own = df.columns.index(column)
    plain = df.toDF(*[f"c{k}" for k in range(len(df.columns))])
    plain = plain.withColumn(f"c{len(df.columns)}", F.col(f"c{own}").cast("string"))  # the text to judge by; not put out

    @tidy
    def run(batches):
        for x in batches:
            mask = pa.array(kept(x.column(x.num_columns - 1)))
            yield pa.RecordBatch.from_arrays([c.filter(mask) for c in x.columns[:-1]], schema=pa.schema(list(x.schema)[:-1]))

    return plain.mapInArrow(run, plain.drop(plain.columns[-1]).schema).toDF(*df.columns)
