"""Sharding by size-tiered compaction.

Arrivals become small immutable shards: each task streams its rows into Parquet files of ``arrival_bytes``. Compaction puts shards into tiers by size
and merges runs of one tier, in the order of their names, into files of about ``target_bytes``; a shard near the target is left alone. Texts are never shuffled: a merge is a
task that streams its inputs into one file.

A manifest is a Parquet table of the shards of a version, and a pointer to it. Commit writes the table, then the pointer under a temporary name, and renames that without overwriting, so readers see
a version whole or not at all, and of two writers one fails and may retry. Files that no task reported, such as those of a lost executor, are in no manifest. Plans, merges and reads
work on manifests as tables: the driver holds a version number and counts, however many shards there are.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StructType

from ..operators.tables import numbered
from .common import checkpoint, partitions, scratch, written

TARGET, ARRIVAL, FANOUT, GROUP_BYTES = 64 << 20, 8 << 20, 4, 16 << 20
_SHARD = "name string, rows long, bytes long"
_SCHEMA = pa.schema([("name", pa.string()), ("rows", pa.int64()), ("bytes", pa.int64())])


@dataclass(frozen=True)
class Shard:
    name: str
    rows: int
    bytes: int


def _fs(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of an address for the Python workers; s3a and s3n, as Hadoop calls it, are s3."""
    scheme, sep, rest = uri.partition("://")
    if sep and scheme in ("s3a", "s3n"):
        uri = f"s3://{rest}"
    return pyarrow.fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


class _Writer:
    """Streams batches into Parquet files of about ``limit`` bytes under new names; without a limit into one."""

    def __init__(self, root: str, stem: str, limit: int | None):
        (self.fs, self.base), self.stem, self.limit = _fs(root), stem, limit
        self.fs.create_dir(f"{self.base}/data", recursive=True)
        self.out, self.made, self.held, self.size, self.rows, self.k = None, [], [], 0, 0, 0

    def write(self, batch: pa.RecordBatch) -> None:
        if not batch.num_rows:
            return
        half = batch.num_rows // 2
        if half and batch.nbytes > GROUP_BYTES:  # long texts: smaller pieces
            self.write(batch.slice(0, half))
            self.write(batch.slice(half))
            return
        self.held.append(batch)
        self.size += batch.get_total_buffer_size() if batch.num_rows == 1 else batch.nbytes
        if self.size >= GROUP_BYTES:
            self._flush()
        if self.limit and self.out and self.sink.tell() + self.size // 2 >= self.limit:
            self._end()

    def _flush(self) -> None:
        if not self.held:
            return
        if not self.out:
            self.name = f"{self.stem}-{self.k:05d}-{uuid.uuid4().hex}.parquet"  # an attempt never meets the files of another
            self.sink = self.fs.open_output_stream(f"{self.base}/data/{self.name}")
            self.out = pq.ParquetWriter(self.sink, self.held[0].schema, compression="zstd")
        table = pa.Table.from_batches(self.held)
        self.out.write_table(table)
        self.rows += table.num_rows
        self.held, self.size = [], 0

    def _end(self) -> None:
        self._flush()
        if self.out:
            self.out.close()
            n = self.sink.tell()
            self.sink.close()
            self.made.append(Shard(self.name, self.rows, n))
            self.out, self.rows, self.k = None, 0, self.k + 1

    def close(self) -> list[Shard]:
        self._end()
        return self.made


def _batch(shards: list[Shard]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([asdict(s) for s in shards], schema=_SCHEMA)


def write_arrivals(df: DataFrame, root: str, name: str, arrival_bytes: int = ARRIVAL) -> DataFrame:
    """Writes the rows of ``df`` as new shards and returns (name, rows, bytes) of those of the attempts that counted; nothing is visible before ``commit``."""
    if len(set(df.columns)) < len(df.columns):
        raise ValueError("shards can't hold two columns of one name")

    def write(batches):
        out = _Writer(root, f"{name}-{TaskContext.get().partitionId():07d}", arrival_bytes)
        for x in batches:
            out.write(pa.RecordBatch.from_arrays(x.columns, names=names))
        yield _batch(out.close())

    names = list(df.columns)
    return written(df.toDF(*[f"c{k}" for k in range(len(names))]).mapInArrow(write, _SHARD), "arrivals")  # Spark takes no dots in names here


def plan(shards: DataFrame, target: int = TARGET, fanout: int = FANOUT, full: bool = False) -> DataFrame:
    """(tier, run, names): the runs to merge, names in order. Shards of one tier are laid end to end in the order of names, and those whose middle lies in the same stretch of
    ``target`` bytes are a run. Tier 0 goes down to target / fanout bytes, tier 1 to target / fanout^2 and so on; shards of three quarters of the target or more are in none.

    A run that stays below three quarters of the target waits until ``fanout`` shards are in it, unless ``full``, which closes the books: all
    that is left below the target is merged, whatever its tier. No run of one shard is merged.
    """
    n = partitions(shards)
    level = F.lit(0) if full else F.greatest(F.lit(0), F.ceil(F.log(float(fanout), F.greatest(F.lit(1.0), F.lit(float(target)) / F.greatest("bytes", F.lit(1)))) - 1e-9) - 1)
    small = shards.where(F.col("bytes") < target * 3 // 4).withColumn("tier", level.cast("int"))
    # A tier may hold any share of the shards: ranges of names are summed by themselves and begin where those before them end.
    parts = checkpoint(small.repartitionByRange(n, "tier", "name").withColumn("part", F.spark_partition_id()))
    before = Window.partitionBy("tier").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("tier", "part").agg(F.sum("bytes").alias("b")).withColumn("start", F.coalesce(F.sum("b").over(before), F.lit(0))).drop("b")
    inside = Window.partitionBy("tier", "part").orderBy("name").rowsBetween(Window.unboundedPreceding, -1)
    at = parts.withColumn("own", F.coalesce(F.sum("bytes").over(inside), F.lit(0))).join(starts, ["tier", "part"])
    run = F.floor((F.col("start") + F.col("own") + F.col("bytes") / 2) / target).cast("long")
    runs = at.withColumn("run", run).groupBy("tier", "run").agg(F.count("*").alias("n"), F.sum("bytes").alias("b"), F.array_sort(F.collect_list("name")).alias("names"))  # about a target's bytes of shards
    ready = F.lit(True) if full else (F.col("n") >= fanout) | (F.col("b") >= target * 3 // 4)
    return runs.where(ready & (F.col("n") > 1)).select("tier", "run", "names")


def merge(runs: DataFrame, count: int, root: str, name: str) -> DataFrame:
    """One task per run; returns the merged shards."""

    def work(batches):
        for x in batches:
            for tier, run, names in zip(*(x.column(c).to_pylist() for c in ("tier", "run", "names"))):
                out = _Writer(root, f"{name}-{tier:02d}-{run:09d}", None)
                for n in names:
                    with out.fs.open_input_file(f"{out.base}/data/{n}") as f:
                        for batch in pq.ParquetFile(f).iter_batches(batch_size=2048):
                            out.write(batch)
                yield _batch(out.close())

    return written(runs.repartitionByRange(count, "tier", "run").mapInArrow(work, _SHARD), "merged")


def versions(spark: SparkSession, root: str) -> list[int]:
    fs, at = _hadoop(spark, f"{root}/manifest")
    return sorted(int(x.getPath().getName()[1:-5]) for x in fs.listStatus(at) if x.getPath().getName().startswith("v")) if fs.exists(at) else []


def _hadoop(spark: SparkSession, uri: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def read_manifest(spark: SparkSession, root: str, version: int | None = None) -> tuple[int, DataFrame]:
    """(version, shards), of the latest version by default; version 0, without shards, where nothing was committed."""
    found = versions(spark, root)
    if not found:
        return 0, spark.createDataFrame([], _SHARD)
    version = found[-1] if version is None else version
    at = json.loads(spark.read.text(f"{root}/manifest/v{version:010d}.json").first().value)["shards"]
    return version, spark.read.schema(_SHARD).parquet(f"{root}/manifest/{at}")


def commit(spark: SparkSession, root: str, shards: DataFrame, after: int) -> int:
    """Makes the shards version ``after`` + 1, or fails with FileExistsError if another writer did so first."""
    at = f"shards-{uuid.uuid4().hex}"
    shards.select("name", "rows", "bytes").write.parquet(f"{root}/manifest/{at}")
    jvm = spark._jvm
    fs, temporary = _hadoop(spark, f"{root}/manifest/.{at}.json")
    out = fs.create(temporary, True)
    out.write(bytearray(json.dumps({"version": after + 1, "shards": at}), "utf-8"))
    out.close()
    _, to = _hadoop(spark, f"{root}/manifest/v{after + 1:010d}.json")
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(temporary, to, how)
    except Exception as e:
        fs.delete(temporary, False)
        fs.delete(_hadoop(spark, f"{root}/manifest/{at}")[1], True)
        if "exist" in str(e).lower():
            raise FileExistsError(f"version {after + 1} of {root} exists") from e
        raise
    return after + 1


def _stored(spark: SparkSession, root: str, shards: DataFrame) -> StructType | None:
    """The columns of the shards, from the footer of one."""
    one = shards.limit(1).collect()
    if not one:
        return None
    fs, base = _fs(root)
    with fs.open_input_file(f"{base}/data/{one[0].name}") as f:
        return from_arrow_schema(pq.ParquetFile(f).schema_arrow)


def append(df: DataFrame, root: str, arrival_bytes: int = ARRIVAL) -> int:
    """Adds the rows of ``df`` as a new version. Rows of other columns, or other types, than those there are an error."""
    spark = df.sparkSession
    version, shards = read_manifest(spark, root)
    there = _stored(spark, root, shards)
    if there is not None and [(f.name, f.dataType.simpleString()) for f in there] != [(f.name, f.dataType.simpleString()) for f in df.schema]:
        raise ValueError(f"the shards of {root} have other columns: {there.simpleString()}")
    return commit(spark, root, shards.unionByName(write_arrivals(df, root, f"{version + 1:06d}-a", arrival_bytes)), version)


def compact(spark: SparkSession, root: str, target: int = TARGET, fanout: int = FANOUT, full: bool = False) -> int:
    """Merges until no run is ready, a version for each round. Returns the last version. A round that merges leaves fewer shards, so it ends."""
    while True:
        version, shards = read_manifest(spark, root)
        runs = checkpoint(plan(shards, target, fanout, full))
        count = runs.count()
        if not count:
            return version
        gone = runs.select(F.explode("names").alias("name"))
        commit(spark, root, shards.join(gone, "name", "left_anti").unionByName(merge(runs, count, root, f"{version + 1:06d}-m")), version)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Deletes the data files that earlier versions list and the last ``keep`` don't; only for when no writer is at work, and those versions can't be read any more. Returns how many."""
    found = versions(spark, root)
    old, new = (None if not vs else _union([read_manifest(spark, root, v)[1].select("name") for v in vs]) for vs in (found[:-keep], found[-keep:]))
    if old is None:
        return 0

    def delete(batches):
        fs, base = _fs(root)
        for x in batches:
            for name in x.column("name").to_pylist():
                if fs.get_file_info(f"{base}/data/{name}").type != pyarrow.fs.FileType.NotFound:  # another attempt may have been here
                    fs.delete_file(f"{base}/data/{name}")
            yield pa.RecordBatch.from_pydict({"n": pa.array([x.num_rows], pa.int64())})

    gone = checkpoint(old.distinct().join(new, "name", "left_anti"))
    return gone.mapInArrow(delete, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _union(dfs: list[DataFrame]) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.union(d)
    return out


def _scan(shards: DataFrame, root: str, columns: list[str] | None, schema: StructType, rows) -> DataFrame:
    """``rows(batch, first row, shard)`` of each batch of each shard, read by tasks: the driver lists no files."""
    arrow, n = to_arrow_schema(schema), max(1, min(shards.count(), 100_000))

    def scan(batches):
        fs, base = _fs(root)
        for x in batches:
            for shard in x.to_pylist():
                at = 0
                with fs.open_input_file(f"{base}/data/{shard['name']}") as f:
                    for b in pq.ParquetFile(f).iter_batches(batch_size=2048, columns=columns):
                        out = rows(b, at, shard)
                        yield pa.RecordBatch.from_arrays([c.cast(t.type) for c, t in zip(out, arrow)], schema=arrow)
                        at += b.num_rows

    return shards.repartitionByRange(n, "name").mapInArrow(scan, schema)


def read(spark: SparkSession, root: str, version: int | None = None, columns: list[str] | None = None) -> DataFrame | None:
    """The rows of a version, with all columns or those named; None where it has none."""
    _, shards = read_manifest(spark, root, version)
    schema = _stored(spark, root, shards)
    if schema is None:
        return None
    own = schema if columns is None else StructType([schema[c] for c in columns])
    return _scan(shards, root, columns, own, lambda b, at, shard: b.columns if columns is None else [b.column(c) for c in columns])


def assign(df: DataFrame, id_col: str = "doc_id", root: str | None = None, target: int = TARGET, arrival_bytes: int = ARRIVAL, fanout: int = FANOUT) -> DataFrame:
    """(id, shard, place, shard_rows) for every row: appends ``df`` to the shards under ``root``, compacts them and reports where each row lies.

    ``shard`` is the position of the file in the manifest by name, ``place`` the row in it. Every row of ``df`` lies in exactly one shard with all its columns,
    be they null, repeated, empty or long; null ids stay, and ids may be of any type. Columns need different names. An empty table makes an empty manifest and gives no rows. A text
    longer than the target makes a shard larger than it. Under a ``root`` that holds shards already, of the same columns, their rows are reported too, and earlier versions stay readable;
    without one a new folder is made, in which only the last version is kept.
    """
    spark, own = df.sparkSession, root is None
    root = root or scratch(spark, "shards")
    append(df, root, arrival_bytes)
    compact(spark, root, target, fanout)
    compact(spark, root, target, fanout, full=True)
    if own:
        vacuum(spark, root, keep=1)
    _, shards = read_manifest(spark, root)
    schema = StructType().add("id", df.schema[id_col].dataType).add("shard", IntegerType()).add("place", LongType()).add("shard_rows", LongType())
    if shards.isEmpty():
        return spark.createDataFrame([], schema)

    def where(b, at, shard):
        n = b.num_rows
        return [b.column(id_col), pa.array([shard["number"] - 1] * n, pa.int32()), pa.array(range(at, at + n), pa.int64()), pa.array([shard["rows"]] * n, pa.int64())]

    return _scan(numbered(shards, [], ["name"]), root, [id_col], schema, where)
