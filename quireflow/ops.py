"""Operations on a folder of control tables: what the command line shows and does. Every report is a DataFrame.

A folder holds jobs, volumes, workers, tasks and messages. A table is replaced as a whole: its next version is written beside the present one, then a pointer is renamed over the
old one, so a reader sees one or the other. One writer at a time is assumed; tasks of a cluster claim through the stream (``streaming.tasks``)."""

from __future__ import annotations

import argparse
import datetime
import json
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .operators import admin, jobs
from .operators.gates import tolerant_gate
from .operators.tables import latest_per_key
from .plans import control
from .sources import lists, sinks

SCHEMAS = {
    "jobs": "job_id int, job_name string, config string, queue_url string, dlq_url string",
    "volumes": "volume_id long, w_id string, i_id string, last_etag string, nb_images int, nb_images_intro int",
    "workers": "worker_id long, worker_name string, last_heartbeat_at timestamp, stopped_at timestamp",
    "tasks": "id long, job_id int, volume_id long, etag string, status string, attempt int, worker_id long, started_at timestamp, done_at timestamp, total_images long, nb_errors long, total_ms double, page_ms double",
    "messages": "message_id long, job_id int, w_id string, i_id string, source string, i_version string, state string, receives int",
}


class Store:
    """The control tables of a folder, as attributes; a table that was never written is empty."""

    def __init__(self, spark: SparkSession, folder: str, now: datetime.datetime | None = None):
        self.spark, self.folder, self.now = spark, folder.rstrip("/"), now or datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def __getattr__(self, name: str) -> DataFrame:
        if name in ("event_clock", "task_clock"):
            return self.spark.createDataFrame([(self.now,)], "now_at timestamp")
        if name not in SCHEMAS:
            raise AttributeError(name)
        fs, at = self._fs(f"{self.folder}/{name}/current")
        if not fs.exists(at):
            return self.spark.createDataFrame([], SCHEMAS[name])
        version = self.spark.read.text(f"{self.folder}/{name}/current").first().value
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}/{version}")

    def replace(self, name: str, df: DataFrame) -> None:
        """Publishes the next version of a table."""
        version = f"v-{uuid.uuid4().hex}"
        kinds = self.spark.createDataFrame([], SCHEMAS[name]).schema
        df.select(*[F.col(f.name).cast(f.dataType) for f in kinds]).write.parquet(f"{self.folder}/{name}/{version}")
        fs, temporary = self._fs(f"{self.folder}/{name}/.{version}")
        out = fs.create(temporary, True)
        out.write(bytearray(version, "utf-8"))
        out.close()
        _, to = self._fs(f"{self.folder}/{name}/current")
        fs.delete(to, False)
        if not fs.rename(temporary, to):
            raise OSError(f"{name} could not be replaced")

    def add(self, name: str, rows: list[tuple]) -> None:
        self.replace(name, getattr(self, name).unionByName(self.spark.createDataFrame(rows, SCHEMAS[name])))


# --- reports

def job_list(s: Store) -> DataFrame:
    return s.jobs.orderBy("job_id")


def job_stats(s: Store) -> DataFrame:
    return control.status_stats(s)


def task_list(s: Store, mode: str = "all", job: str | None = None, worker: str | None = None, limit: int = 20) -> DataFrame:
    """The most recent tasks in error, those without a time first."""
    job_id = admin.found(s.jobs, "job", "job_id", "job_name", job).first().job_id if job else None
    worker_id = admin.found(s.workers, "worker", "worker_id", "worker_name", worker).first().worker_id if worker else None
    failed = control.failed_tasks(s, mode, job_id, worker_id).join(s.volumes, "volume_id").join(s.jobs, "job_id").join(s.workers, "worker_id", "left")
    return failed.orderBy(F.desc_nulls_first(F.coalesce("done_at", "started_at")), "id").limit(limit).select("id", "job_name", "w_id", "i_id", "worker_name", "status", "attempt", "nb_errors", T.version_of(F.col("etag")).alias("version"))


def worker_list(s: Store) -> DataFrame:
    return control.worker_overview(s)


def worker_stats(s: Store) -> DataFrame:
    return control.worker_counts(s)


def fleet(s: Store) -> DataFrame:
    return control.fleet(s)


def queue_stats(s: Store) -> DataFrame:
    n = lambda state: F.count(F.when(F.col("state") == state, 1)).alias(state)
    return s.messages.groupBy("job_id").agg(n("available"), n("in_flight"), n("delayed"), n("dead"))


def artifact_prefix(s: Store, w_id: str, i_id: str, job: str, source: str | None = None, i_version: str | None = None) -> str:
    """root/w/i/version of a volume's artifacts for a job; the root is the job's name or the prefix its configuration sets."""
    row = admin.found(s.jobs, "job", "job_id", "job_name", job).first()
    root = str(json.loads(row.config or "{}").get("artifact_prefix") or row.job_name).strip("/")
    at = lists.routed(s.spark.createDataFrame([(w_id, i_id, source, i_version)], "w_id string, i_id string, source string, i_version string")).first()
    if at.source != lists.SOURCES[0]:
        return f"{root}/{at.db_w_id}/{i_id}/{i_version}"
    etag = s.volumes.where((F.col("w_id") == w_id) & (F.col("i_id") == i_id)).select(T.version_of(F.col("last_etag")).alias("v")).first()
    if etag is None:
        raise LookupError(f"volume {w_id} {i_id} not found")
    return f"{root}/{at.db_w_id}/{i_id}/{etag.v}"


# --- actions

def create_job(s: Store, name: str, queue_url: str, config: str = "{}", dlq_url: str | None = None) -> None:
    s.replace("jobs", admin.created(s.jobs, name, queue_url, config, dlq_url))


def delete_job(s: Store, job: str) -> None:
    left, tasks = admin.deleted(s.jobs, s.tasks, admin.found(s.jobs, "job", "job_id", "job_name", job).first().job_id)
    s.replace("tasks", tasks)
    s.replace("jobs", left)


def enqueue(s: Store, job: str, path: str, limit: int | None = None, again: bool = False) -> tuple[int, int]:
    """(sent, skipped): queues the volumes of a list, but those the job has done in their present version, unless ``again``."""
    job_id = admin.found(s.jobs, "job", "job_id", "job_name", job).first().job_id
    done = s.tasks.where((F.col("job_id") == job_id) & (F.col("status") == "done")).select("volume_id", F.col("etag").alias("last_etag"))
    finished = s.volumes.join(done, ["volume_id", "last_etag"], "left_semi").select("w_id", "i_id")
    listed = lists.read_volume_list(s.spark, path)
    left = listed if again else lists.read_volume_list(s.spark, path, finished, limit)
    rows = left.limit(limit).collect() if again and limit else left.collect()  # a list of volumes is a text file that a user wrote
    top = s.messages.agg(F.coalesce(F.max("message_id"), F.lit(0))).first()[0]
    s.add("messages", [(top + k, job_id, r.w_id, r.i_id, r.source, r.version, "available", 0) for k, r in enumerate(rows, 1)])
    return len(rows), 0 if again else listed.join(finished, ["w_id", "i_id"], "left_semi").count()


def redrive(s: Store, job: str, limit: int = 1000) -> int:
    """Brings dead letters back to the queue, at most so many."""
    job_id = admin.found(s.jobs, "job", "job_id", "job_name", job).first().job_id
    back = s.messages.where((F.col("job_id") == job_id) & (F.col("state") == "dead")).orderBy("message_id").limit(limit).select("message_id", F.lit(True).alias("back"))
    n = back.count()
    s.replace("messages", s.messages.join(F.broadcast(back), "message_id", "left").withColumn("receives", F.when(F.col("back"), 0).otherwise(F.col("receives"))).withColumn("state", F.when(F.col("back"), "available").otherwise(F.col("state"))).drop("back"))
    return n


def purge(s: Store, job: str) -> None:
    job_id = admin.found(s.jobs, "job", "job_id", "job_name", job).first().job_id
    s.replace("messages", s.messages.where(F.col("job_id") != job_id))


def run_volume(s: Store, job: str, w_id: str, i_id: str, pages: DataFrame, out: str, worker_id: int | None = None, force: bool = False) -> str:
    """Runs a job on one volume without the queue and returns what was decided: skip_ack, claim, force or stale.

    The decision is that of the queue's worker: a success marker or a present claim that isn't stale means to skip, unless forced. Results are done, or failed so that it is worth
    another try or not, by the share of pages that failed; an error of the job itself is recorded by its kind and raised."""
    row = admin.found(s.jobs, "job", "job_id", "job_name", job).first()
    volume = s.volumes.where((F.col("w_id") == w_id) & (F.col("i_id") == i_id)).first()
    if volume is None:
        raise LookupError(f"volume {w_id} {i_id} not found")
    prefix = f"{out.rstrip('/')}/{artifact_prefix(s, w_id, i_id, job)}"
    fs, marker = s._fs(f"{prefix}/success.json")
    own = (F.col("job_id") == row.job_id) & (F.col("volume_id") == volume.volume_id) & (F.col("etag") == volume.last_etag)
    have = latest_per_key(s.tasks.where(own), ["job_id", "volume_id", "etag"], F.desc("id")).first()
    old = bool(have and have.started_at and have.started_at < s.now - datetime.timedelta(minutes=5))
    facts = s.spark.createDataFrame([(bool(fs.exists(marker)), have is not None, force, old)], "marker boolean, present boolean, force boolean, old boolean")
    decision = facts.select(control.claim_decision().alias("d")).first().d
    if decision == "skip_ack":
        return decision
    number = have.id if have else s.tasks.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0] + 1
    claim = (number, row.job_id, volume.volume_id, volume.last_etag, "running", (have.attempt if have else 0) + 1, worker_id, s.now, None, None, None, None, None)
    keep = lambda: s.tasks.where(F.col("id") != number)
    publish = lambda values: s.replace("tasks", keep().unionByName(s.spark.createDataFrame([values], SCHEMAS["tasks"])))
    publish(claim)
    began = datetime.datetime.now()
    try:
        result = jobs.run(row.job_name, pages, json.loads(row.config or "{}"))
        name = "img_file_name" if "img_file_name" in result.columns else result.columns[0]
        made = result if "ok" in result.columns else result.withColumn("ok", F.col("error_stage").isNull())
        counters = sinks.write_artifact(made, f"{prefix}/pages.parquet", f"{prefix}/errors.jsonl", name=name)
    except Exception as e:
        kind = T.failure_class(F.lit(type(e).__name__), F.lit(str(e)))["retryable"]
        retry = s.spark.range(1).select(kind.alias("r")).first().r
        publish((*claim[:4], "retryable_failed" if retry else "terminal_failed", *claim[5:]))
        raise
    ms = (datetime.datetime.now() - began).total_seconds() * 1000
    n, errors, skipped = counters["rows"], counters["errors"], counters.get("skipped", 0)
    verdict = s.spark.range(1).select(tolerant_gate(F.lit(n), F.lit(skipped), F.lit(errors), F.lit(errors)).alias("v")).first().v
    status = {"done": "done", "retryable": "retryable_failed", "terminal": "terminal_failed"}[verdict]
    publish((*claim[:4], status, *claim[5:8], s.now, n, errors, ms, ms / max(n, 1)) if status == "done" else (*claim[:4], status, *claim[5:8], s.now, *claim[9:]))
    if status == "done":
        sinks.write_marker(s.spark, f"{prefix}/success.json", {"job": row.job_name, "w_id": w_id, "i_id": i_id, "total_images": n, "nb_errors": errors, "total_ms": ms})
    return decision


REPORTS: dict[str, Callable[..., DataFrame]] = {"jobs": job_list, "job-stats": job_stats, "errors": task_list, "workers": worker_list, "worker-stats": worker_stats, "fleet": fleet, "queue": queue_stats}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """``python -m quireflow.ops FOLDER COMMAND ...``"""
    p = argparse.ArgumentParser(prog="quireflow.ops")
    p.add_argument("folder")
    c = p.add_subparsers(dest="command", required=True)
    for name in REPORTS:
        r = c.add_parser(name)
        if name == "errors":
            r.add_argument("--type", dest="mode", choices=("all", "task-failed", "image-errors"), default="all")
            r.add_argument("--job")
            r.add_argument("--worker")
            r.add_argument("--limit", type=int, default=20)
    for name, more in {"create-job": ("name", "queue_url"), "delete-job": ("job",), "enqueue": ("job", "path"), "redrive": ("job",), "purge": ("job",), "run-volume": ("job", "w_id", "i_id", "pages", "out")}.items():
        a = c.add_parser(name)
        for m in more:
            a.add_argument(m)
        if name in ("enqueue", "redrive"):
            a.add_argument("--limit", type=int, default=1000 if name == "redrive" else None)
        if name == "run-volume":
            a.add_argument("--force", action="store_true")
    args = vars(p.parse_args(argv))
    spark = spark or SparkSession.builder.getOrCreate()
    s, command = Store(spark, args.pop("folder")), args.pop("command")
    try:
        if command in REPORTS:
            REPORTS[command](s, **args).show(truncate=False)
        elif command == "run-volume":
            print(run_volume(s, args["job"], args["w_id"], args["i_id"], spark.read.parquet(args["pages"]), args["out"], force=args["force"]))
        else:
            done = {"create-job": create_job, "delete-job": delete_job, "enqueue": enqueue, "redrive": redrive, "purge": purge}[command](s, **args)
            print("done" if done is None else done)
    except (LookupError, ValueError) as e:
        print(e, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
