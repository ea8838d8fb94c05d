"""Sinks: page artifacts with an error sidecar, responses, markers and reports."""

from __future__ import annotations

import itertools
import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def message_attributes(default: str = "archive"):
    """The attributes of a message to a queue as JSON, of w_id, i_id, source and i_version: empty ones and the default source are left out."""
    some = lambda c: F.nullif(F.col(c), F.lit(""))
    return F.to_json(F.struct(some("w_id").alias("w_id"), some("i_id").alias("i_id"), F.nullif(some("source"), F.lit(default)).alias("source"), some("i_version").alias("i_version")))


def send_batches(df: DataFrame, send: Callable[[list[dict]], list[str]], size: int = 10) -> None:
    """Sends the rows in batches; ``send`` gives the ids (places in the batch) that weren't taken, and any of them is an error. Tasks may be tried again, so a row may be sent twice."""

    def run(rows):
        rows = iter(rows)
        while batch := [{"id": str(k), **r.asDict()} for k, r in enumerate(itertools.islice(rows, size))]:
            if failed := send(batch):
                raise RuntimeError(f"{len(failed)} messages of a batch weren't sent: {', '.join(failed)}")

    df.foreachPartition(run)


#: Columns of page artifacts by the kind of job; every one ends with the error envelope.
ENVELOPE = "ok boolean, error_stage string, error_type string, error_message string"
_POINTS = "array<struct<x:smallint,y:smallint>>"
_RECTS = "array<struct<x:smallint,y:smallint,w:smallint,h:smallint>>"
SCHEMAS = {
    "line_detection": f"img_file_name string, source_etag string, rotation_angle float, tps_points array<array<float>>, tps_alpha float, contours array<{_POINTS}>, nb_contours int, contours_bboxes {_RECTS}, {ENVELOPE}",
    "line_text": f"img_file_name string, source_etag string, rotation_angle float, tps_points array<array<float>>, tps_alpha float, line_bboxes {_RECTS}, line_texts array<string>, nb_lines int, {ENVELOPE}",
    "page_text": f"img_file_name string, source_etag string, truncated boolean, finish_reason string, page_text string, output_tokens int, model_id string, {ENVELOPE}",
    "page_text_layout": f"img_file_name string, source_etag string, truncated boolean, finish_reason string, page_text string, output_tokens int, model_id string, raw_text string, rep_score double, likely_loop boolean, res_scale double, dry_fires int, dry_max_l int, "
    f"retried boolean, skipped boolean, skip_reason string, layout_masked boolean, n_masked_boxes int, n_columns int, footnote_text string, n_footnotes int, removed string, {ENVELOPE}",
    "page_class": f"img_file_name string, source_etag string, exif_orientation_tag int, label string, prob float, probs array<float>, labels array<string>, model_version string, {ENVELOPE}",
    "cloud_text": f"img_file_name string, img_idx smallint, source_etag string, nb_pages smallint, languages array<string>, confidence float, text_len int, nb_lines smallint, text string, {ENVELOPE}",
}


def conformed(df: DataFrame, kind: str) -> DataFrame:
    """The columns of an artifact in their order and types; one that ``df`` lacks is null, but ok, which is true where there is no error."""
    schema = df.sparkSession.createDataFrame([], SCHEMAS[kind]).schema
    made = df if "ok" in df.columns else df.withColumn("ok", F.col("error_stage").isNull() if "error_stage" in df.columns else F.lit(True))
    return made.select(*[(F.col(f.name) if f.name in made.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def write_pages(df: DataFrame, kind: str, path: str, errors_path: str, files: int | None = None) -> dict:
    """Writes an artifact of this kind with its sidecar. The counters are rows, ok, errors and, of kinds that have them, truncated, loops and skipped."""
    return write_artifact(conformed(df, kind), path, errors_path, files, name="img_file_name")


def write_artifact(df: DataFrame, path: str, errors_path: str, files: int | None = None, name: str = "file") -> dict:
    """Writes pages (zstd, 64 KB pages) and, of those that aren't ok, a JSON-lines sidecar; a stale sidecar is replaced, and removed if there are no errors. Returns counters, taken in the same pass."""
    seen = Observation()
    n = lambda c: F.count(F.when(c, 1))
    flags = {"truncated": "truncated", "loops": "likely_loop", "skipped": "skipped"}
    more = [n(F.col(c)).alias(k) for k, c in flags.items() if c in df.columns]
    counted = df.observe(seen, F.count("*").alias("rows"), n(F.col("ok")).alias("ok"), n(~F.col("ok")).alias("errors"), *more)
    out = counted.coalesce(files) if files else counted
    out.write.mode("overwrite").option("compression", "zstd").option("parquet.page.size", 65536).parquet(path)
    counters = seen.get
    if counters["errors"]:
        stages = [c for c in ("source_etag", "error_stage", "error_type", "error_message") if c in df.columns]
        df.sparkSession.read.schema(df.schema).parquet(path).where("not ok").select(name, *stages).write.mode("overwrite").json(errors_path)
    else:
        at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(errors_path)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
    return counters


def write_responses(df: DataFrame, path: str, order: str) -> None:
    """Zstandard JSON lines, each file in the order of the page index. Spark's JSON writer has no zstandard without native Hadoop, so tasks write the files: under a name of
    their attempt, renamed when whole."""
    import zstandard

    columns = df.columns

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        c = TaskContext.get()
        base = path.removeprefix("file://")
        fs, root = pa.fs.FileSystem.from_uri(path) if ":/" in path else (pa.fs.LocalFileSystem(), base)
        fs.create_dir(root, recursive=True)
        name, rows = f"part-{c.partitionId():05d}.jsonl.zst", 0
        with fs.open_output_stream(f"{root}/.{name}-{c.taskAttemptId()}", compression=None) as f, zstandard.ZstdCompressor().stream_writer(f, closefd=False) as z:
            for b in batches:
                for line in b.column("line").to_pylist():
                    z.write(line.encode() + b"\n")
                    rows += 1
        fs.move(f"{root}/.{name}-{c.taskAttemptId()}", f"{root}/{name}")
        yield pa.RecordBatch.from_pydict({"rows": pa.array([rows], pa.int64())})

    import pyarrow.fs  # noqa: F401

    lines = df.repartitionByRange(order).sortWithinPartitions(order).select(F.to_json(F.struct(*columns)).alias("line"))
    lines.mapInArrow(run, "rows long").agg(F.sum("rows")).collect()


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).csv(path)


def write_marker(spark, path: str, content: dict) -> None:
    """The success marker, written whole under another name and then renamed; its existence is what counts."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs, temporary = at.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path(f"{path}.writing")
    out = fs.create(temporary, True)
    out.write(bytearray(json.dumps(content, sort_keys=True), "utf-8"))
    out.close()
    fs.delete(at, False)
    if not fs.rename(temporary, at):
        raise OSError(f"{path} could not be put in place")


def report(df: DataFrame, title: str) -> str:
    """A Markdown table of a small aggregate."""
    rows = df.collect()
    head = [f"# {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(head + ["| " + " | ".join("-" if v is None else str(v) for v in r) + " |" for r in rows]) + "\n"


def resume(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What isn't done yet."""
    return df.join(done.select(key), key, "left_anti")


def write_texts(df: DataFrame, folder: str) -> None:
    """A JSON file for each row (name, text): written under another name and then renamed, so that what is there is whole."""

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs as pfs

        fs, root = pfs.FileSystem.from_uri(folder) if ":/" in folder else (pfs.LocalFileSystem(), folder)
        fs.create_dir(root, recursive=True)
        local = isinstance(fs, pfs.LocalFileSystem)
        for b in batches:
            for name, text in zip(b.column("name").to_pylist(), b.column("text").to_pylist()):
                if local:  # two calls a file, without the library's objects
                    with open(f"{root}/.{name}.writing", "wb") as f:
                        f.write(text.encode())
                    os.replace(f.name, f"{root}/{name}.json")
                    continue
                with fs.open_output_stream(f"{root}/.{name}.writing") as f:
                    f.write(text.encode())
                fs.move(f"{root}/.{name}.writing", f"{root}/{name}.json")
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())})

    df.mapInArrow(run, "n long").agg(F.sum("n")).collect()


def write_items(df: DataFrame, folder: str, key: str) -> None:
    """A JSON file for each row, named by its key. Rows that are there already are written again; ``resume`` leaves them out."""
    write_texts(df.select(F.col(key).cast("string").alias("name"), F.to_json(F.struct(*df.columns)).alias("text")), folder)


def read_items(spark, folder: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("pathGlobFilter", "[!.]*.json").json(folder)
