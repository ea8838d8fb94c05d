"""Sources: volume lists, messages, label files, manifests, listings, error sidecars, recognition responses, telemetry, artifacts and SQL tables."""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import bound
from ..functions import text as T
from ..functions.geometry import median_of

#: The sources of images; the first is the default, has a manifest of its own and takes its version from it, the others need one.
SOURCES = ("archive", "benchmark")
IMAGES = "jpg|jpeg|png|tif|tiff"
CLASSES = ("header", "text-area", "footnote", "footer")


def is_image(name: Column) -> Column:
    """Whether a file of this name lies directly in its folder and is an image by its extension, of either case."""
    return F.lower(name).rlike(rf"^[^/]*\.({IMAGES})$")


def parsed_volumes(lines: DataFrame, default: str = SOURCES[0]) -> DataFrame:
    """(w_id, i_id, source, version) of lines with 2 to 4 fields parted by commas or white space; comments, blanks and other lines are left out."""
    line = F.trim("value")
    parts = lines.where((line != "") & ~line.startswith("#")).select(F.split(F.trim(F.regexp_replace("value", r"[,\s]+", " ")), " ").alias("p")).where(F.size("p").between(2, 4))
    return parts.select(F.col("p")[0].alias("w_id"), F.col("p")[1].alias("i_id"), F.lower(F.coalesce(F.get("p", F.lit(2)), F.lit(default))).alias("source"), F.get("p", F.lit(3)).alias("version"))


def read_volume_list(spark: SparkSession, path: str, done: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """The volumes of a list, less those in ``done`` (w_id, i_id); the limit counts what is left."""
    out = parsed_volumes(spark.read.text(path))
    if done is not None:
        out = out.join(done, ["w_id", "i_id"], "left_anti")
    return out if limit is None else out.limit(limit)


def parsed_messages(messages: DataFrame) -> DataFrame:
    """Adds w_id, i_id, source and i_version to messages with ``attributes`` and a JSON ``body``: of each field the attribute counts, else the body, if it is JSON.
    Sources are trimmed and in lower case. A message without w_id or i_id is an error."""
    field = lambda k: F.coalesce(F.try_element_at("attributes", F.lit(k)), F.get_json_object("body", f"$.{k}"))
    needed = lambda k: F.coalesce(field(k), F.raise_error(F.lit(f"a message without {k}")).cast("string")).alias(k)
    return messages.select("*", needed("w_id"), needed("i_id"), F.lower(F.trim(field("source"))).alias("source"), field("i_version").alias("i_version"))


def parsed_labels(lines: DataFrame) -> DataFrame:
    """Adds cls, label, x, y, w and h of ``cls x y w h`` lines. A class may be written as 1 or 1.0; those of no known class, without five numbers or with a size that isn't positive are left out."""
    p = F.split(F.trim("value"), r"\s+")
    num = lambda k: F.get(p, F.lit(k)).try_cast("double")
    out = lines.select("*", num(0).cast("int").alias("cls"), num(1).alias("x"), num(2).alias("y"), num(3).alias("w"), num(4).alias("h"))
    names = F.array(*[F.lit(c) for c in CLASSES])
    return out.withColumn("label", F.when(F.col("cls") >= 0, F.get(names, F.col("cls")))).where("label is not null and x is not null and y is not null and w > 0 and h > 0")


def routed(df: DataFrame, sources: tuple[str, ...] = SOURCES) -> DataFrame:
    """Adds where a volume comes from: source is trimmed and lowered, null is the default; an unknown source, or one without a version that needs it, fails."""
    s = F.coalesce(F.nullif(F.lower(F.trim("source")), F.lit("")), F.lit(sources[0]))
    checked = F.when(~s.isin(*sources), F.raise_error(F.concat(F.lit("unknown source "), s)).cast("string")).when((s != sources[0]) & F.col("i_version").isNull(), F.raise_error(F.lit("a version is needed")).cast("string")).otherwise(s)
    return df.withColumn("source", checked).withColumn("db_w_id", F.when(F.col("source") == sources[0], F.col("w_id")).otherwise(F.concat("source", F.lit(":"), "w_id")))


def utc_time(text: Column) -> Column:
    """The time of a text; one without a zone is in UTC."""
    zoned = text.rlike(r"(Z|[+-]\d\d:?\d\d)$")
    return F.to_timestamp(F.when(zoned, text).otherwise(F.concat(text, F.lit("Z"))))


def read_errors(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Error sidecars of both generations, plain or gzipped; lines that aren't JSON are left out."""
    schema = "img_filename string, img_file_name string, stage string, error_type string, message string, error_message string, retryable boolean, attempt int, _corrupt_record string"
    raw = spark.read.schema(schema).option("mode", "PERMISSIVE").json(paths)
    return raw.where("_corrupt_record is null").select(F.coalesce("img_filename", "img_file_name").alias("file"), "stage", "error_type", F.coalesce("message", "error_message").alias("message"), "retryable", "attempt")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(page_index, filename) of the images of a JSON manifest, plain or gzipped."""
    m = spark.read.schema("filename string").option("multiLine", True).json(path)
    m = m.select(F.monotonically_increasing_id().alias("at"), "filename").where(is_image(F.col("filename")))
    return m.select((F.row_number().over(Window.orderBy("at")) - 1).alias("page_index"), "filename")  # a manifest is one volume's, some thousand lines


@F.pandas_udf(StringType())
def _local_etag(path: pd.Series, length: pd.Series) -> pd.Series:
    def one(p, n):
        at = p.removeprefix("file:")
        return f"local:{n}:{os.stat('/' + at.lstrip('/')).st_mtime_ns}"

    return pd.Series([one(p, n) for p, n in zip(path, length)])


def list_images(spark: SparkSession, folder: str) -> DataFrame:
    """(path, filename, length, modified, etag) of the images directly in a folder, by name; contents aren't read. Local files have a tag of size and time
    of change in nanoseconds, others none. A folder without images is an error."""
    files = spark.read.format("binaryFile").load(folder).drop("content")
    name = F.regexp_extract("path", "([^/]*)$", 1)
    out = files.select("path", F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias("filename"), "length", F.col("modificationTime").alias("modified")).where(is_image(F.col("filename")))
    if out.isEmpty():
        raise FileNotFoundError(f"no images in {folder}")
    tag = F.when(F.col("path").startswith("file:"), _local_etag("path", "length")) if folder.startswith(("file:", "/")) else F.lit(None).cast("string")
    return out.withColumn("etag", tag).orderBy("filename")


def listed_manifest(spark: SparkSession, folder: str, source: str, w_id: str, i_id: str, version: str) -> tuple[DataFrame, str, str]:
    """((page_index, filename), etag, time of the last change) of a source that has no manifests: the images of its folder; the tag stands for the version."""
    import hashlib

    files = list_images(spark, folder)
    pages = files.select((F.row_number().over(Window.orderBy("filename")) - 1).alias("page_index"), "filename")  # one volume
    last = files.agg(F.max("modified")).first()[0]
    return pages, hashlib.md5(f"{source}|{w_id}|{i_id}|{version}".encode()).hexdigest(), last.isoformat()


_PROPERTY = "struct<detectedLanguages: array<struct<languageCode: string, confidence: double>>>"
_PARAGRAPHS = f"array<struct<property: {_PROPERTY}, words: array<struct<confidence: double>>>>"
_BLOCKS = f"array<struct<property: {_PROPERTY}, paragraphs: {_PARAGRAPHS}>>"
RESPONSE = f"responses array<struct<context: struct<uri: string>, fullTextAnnotation: struct<text: string, pages: array<struct<property: {_PROPERTY}, blocks: {_BLOCKS}>>>>>"


def _some(c: Column, kind: str) -> Column:
    """An array, an empty one of this type in place of null."""
    return F.coalesce(c, F.array().cast(kind))


def _ranked(page: Column) -> Column:
    """The codes of the languages of a page by falling confidence, equals in the order they come in: those it names itself, else those of its blocks and paragraphs, each with its greatest."""
    kind = "array<struct<languageCode:string,confidence:double>>"
    own = lambda x: _some(x["property"]["detectedLanguages"], kind)
    inner = F.flatten(F.transform(_some(page["blocks"], _BLOCKS), lambda b: F.concat(own(b), F.flatten(F.transform(_some(b["paragraphs"], _PARAGRAPHS), own)))))
    sure = lambda x: F.coalesce(x["confidence"], F.lit(0.0))

    def best(named):
        codes = F.array_distinct(F.transform(named, lambda x: x["languageCode"]))
        return F.transform(codes, lambda c: F.struct(c.alias("languageCode"), F.array_max(F.transform(F.filter(named, lambda x: x["languageCode"] == c), sure)).alias("confidence")))

    chosen = F.when(F.size(own(page)) > 0, own(page)).otherwise(bound(F.filter(inner, lambda x: x["languageCode"] != ""), best))
    order = F.array_sort(F.transform(chosen, lambda x, k: F.struct((-sure(x)).alias("c"), k.alias("k"), x["languageCode"].alias("code"))))
    return F.transform(order, lambda x: x["code"])


def parsed_responses(files: DataFrame) -> DataFrame:
    """(uri, file, place, nb_pages, languages, confidence, text_len, nb_lines, text) of each recognition response in files (file, value) of JSON; a file that isn't JSON has none.

    Languages and words are those of the first page. The confidence is the median of the words, 0 if there are none; ``nb_lines`` counts lines in the script."""
    r = files.select("file", F.posexplode(F.from_json("value", RESPONSE)["responses"]).alias("place", "r"))
    pages = F.col("r.fullTextAnnotation.pages")
    words = lambda page: F.flatten(F.transform(_some(page["blocks"], _BLOCKS), lambda b: F.flatten(F.transform(_some(b["paragraphs"], _PARAGRAPHS), lambda p: _some(p["words"], "array<struct<confidence:double>>")))))
    median = lambda page: median_of(F.array_sort(F.transform(words(page), lambda w: F.coalesce(w["confidence"], F.lit(0.0)))))
    first = F.get(pages, F.lit(0))
    seen = bound(first, lambda p: F.when(p.isNotNull(), F.struct(_ranked(p).alias("languages"), median(p).alias("confidence"))))
    text = F.coalesce("r.fullTextAnnotation.text", F.lit(""))
    out = r.select(F.coalesce("r.context.uri", F.lit("")).alias("uri"), "file", "place", F.coalesce(F.size(pages), F.lit(0)).alias("nb_pages"), seen.alias("s"), text.alias("text"))
    return out.select("uri", "file", "place", "nb_pages", _some(F.col("s.languages"), "array<string>").alias("languages"), F.coalesce("s.confidence", F.lit(0.0)).alias("confidence"), F.length("text").cast("long").alias("text_len"), T.script_lines(F.col("text")).alias("nb_lines"), "text")


def matched_responses(responses: DataFrame, pages: DataFrame) -> DataFrame:
    """The pages (uri, ...) for which a response came, with the first of several in the order of files."""
    first = responses.groupBy("uri").agg(F.min_by(F.struct(*[c for c in responses.columns if c != "uri"]), F.struct("file", "place")).alias("r"))
    return pages.join(first, "uri").select(*pages.columns, "r.*")


def read_telemetry(spark: SparkSession, folder: str) -> DataFrame:
    """(id, record) of a folder of JSON files, one record each, named by its own id or else by its file. A missing folder is empty, and files that aren't JSON are left out."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "id string, record string")
    raw = read_small_files(spark, folder, ".json").select("value", F.expr("left(name, length(name) - 5)").alias("name"))
    sound = raw.where(F.try_parse_json("value").isNotNull())
    return sound.select(F.coalesce(F.nullif(F.get_json_object("value", "$.id"), F.lit("")), "name").alias("id"), F.col("value").alias("record"))


def read_small_files(spark: SparkSession, folder: str, ending: str) -> DataFrame:
    """(name, value) of the files of a folder, hidden ones left out, with their whole text. One task lists their names and all read; Spark's own source makes a task of some thirty
    files, and its driver holds an object for each."""

    def names(batches):
        for _ in batches:
            own = (n for n in _listed(folder) if n.endswith(ending) and n[0] not in "._")
            while part := list(itertools.islice(own, 10_000)):
                yield pa.RecordBatch.from_pydict({"name": pa.array(part, pa.string())})

    def texts(batches):
        with ThreadPoolExecutor(4) as pool:
            for b in batches:
                for k in range(0, b.num_rows, 1000):
                    part = b.column(0).slice(k, 1000)
                    yield pa.RecordBatch.from_arrays([part, pa.array(pool.map(_reader(folder), part.to_pylist()), pa.string())], ["name", "value"])

    return spark.range(0, 1, 1, 1).mapInArrow(names, "name string").repartition("name").mapInArrow(texts, "name string, value string")


def _opened(folder: str):
    """(file system, folder there); the file system is None for a local one."""
    local = re.sub(r"^file:/+", "/", folder)
    if not re.match(r"\w+:/", local):
        return None, local
    from pyarrow import fs as pfs

    return pfs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", folder))


def _listed(folder: str) -> Iterator[str]:
    fs, root = _opened(folder)
    if fs is None:
        with os.scandir(root) as found:
            yield from (x.name for x in found if x.is_file())
    else:
        from pyarrow import fs as pfs

        yield from (x.base_name for x in fs.get_file_info(pfs.FileSelector(root)) if x.is_file)


def _reader(folder: str) -> Callable[[str], str]:
    fs, root = _opened(folder)

    def read(name: str) -> str:
        if fs is None:
            with open(f"{root}/{name}", "rb") as f:
                return f.read().decode(errors="replace")
        with fs.open_input_stream(f"{root}/{name}") as f:
            return f.read().decode(errors="replace")

    return read


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of an artifact for debugging: JSON lines, gzipped or not, or Parquet, by the name of the file."""
    return spark.read.json(path) if path.endswith((".jsonl", ".jsonl.gz", ".json", ".json.gz")) else spark.read.parquet(path)


def attached(pages: DataFrame, artifact: DataFrame | None, key: str, columns: list[str], required: bool = False) -> DataFrame:
    """Pages with columns of another job's artifact, null where that has no row for them. Without the artifact (None) all are null, or it is an error if required.

    One join; of several rows for a page the least counts."""
    if artifact is None:
        if required:
            raise FileNotFoundError("the artifact that this job needs is missing")
        return pages.withColumns({c: F.lit(None) for c in columns})
    one = artifact.groupBy(key).agg(F.min(F.struct(*columns)).alias("_row"))
    return pages.join(one, key, "left").select(*[pages[c] for c in pages.columns], *[F.col(f"_row.{c}").alias(c) for c in columns])


def read_sql(spark: SparkSession, url: str, query: str, properties: dict[str, str] | None = None, partition: tuple[str, int, int, int] | None = None) -> DataFrame:
    """The rows of a query or table of a database. ``partition`` (column, low, high, parts) reads it by so many connections; properties take the driver, the login and TLS."""
    reader = spark.read.format("jdbc").option("url", url).options(**(properties or {}))
    if partition:
        column, low, high, parts = partition
        return reader.option("dbtable", query if " " not in query else f"({query}) q").option("partitionColumn", column).option("lowerBound", low).option("upperBound", high).option("numPartitions", parts).load()
    return (reader.option("query", query) if " " in query else reader.option("dbtable", query)).load()
