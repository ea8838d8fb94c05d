"""Streaming queries, drained from the events table."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.pages import per_page
from ..session import shared_path
from ..sources.sinks import write_texts
from ..streaming import tasks
from .registry import query


def _events(e) -> DataFrame:
    return tasks.queue(e.spark, e.sf_dir, e.events.schema, "events.parquet")


def _drained(e, stream: DataFrame, name: str) -> DataFrame:
    return tasks.drained(stream, shared_path(e.spark, name), shared_path(e.spark, f"{name}-checkpoint"))


@query("x01_drain_queue", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def drain(e) -> DataFrame:
    return _drained(e, _events(e), "drain").groupBy("event_type").agg(F.count("*").alias("n"))


@query("x04_first_claims", "SELECT DISTINCT user_id, event_type FROM events")
def first_claims(e) -> DataFrame:
    return _drained(e, tasks.claims(_events(e).withColumn("ts", F.col("ts").cast("timestamp")), ["user_id", "event_type"], "ts", "3650 days"), "claims").select("user_id", "event_type")


@query("x08_worker_liveness", "SELECT user_id, count(*) AS n, max(ts) AS last_seen FROM events GROUP BY user_id")
def liveness(e) -> DataFrame:
    out = {}

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.parquet(path := shared_path(e.spark, f"live-{number}"))
        out["path"] = path

    live = tasks.liveness(_events(e), "user_id", "ts")
    live.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", shared_path(e.spark, "live-checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return e.spark.read.parquet(out["path"])


_FATES = """ev AS (SELECT user_id AS m, epoch_us(CAST(ts AS TIMESTAMP)) / 1000000.0 AS t_, CASE event_type WHEN 'purchase' THEN 'ack' WHEN 'click' THEN 'extend' ELSE 'receive' END AS action FROM events),
    o AS (SELECT *, row_number() OVER (PARTITION BY m ORDER BY t_, action) AS k FROM ev),
    f AS (SELECT DISTINCT m, CAST(0 AS BIGINT) AS k, 0.0::DOUBLE AS hidden, 0 AS n, CAST(NULL AS VARCHAR) AS outcome FROM ev UNION ALL
      SELECT m, k, CASE WHEN outcome IN ('acked', 'dead') THEN 0.0 WHEN outcome IN ('extended', 'delivered') THEN t_ + 450 ELSE hidden END, CASE WHEN outcome IN ('acked', 'dead') THEN 0 WHEN outcome = 'delivered' THEN n + 1 ELSE n END, outcome
      FROM (SELECT o.m, o.k, o.t_, f.hidden, f.n, CASE WHEN o.action = 'ack' THEN CASE WHEN f.n > 0 AND o.t_ <= f.hidden THEN 'acked' ELSE 'stale' END WHEN o.action = 'extend' THEN CASE WHEN f.n > 0 AND o.t_ <= f.hidden THEN 'extended' ELSE 'stale' END
        WHEN f.n > 0 AND o.t_ < f.hidden THEN 'hidden' WHEN f.n >= 3 THEN 'dead' ELSE 'delivered' END AS outcome FROM f JOIN o ON o.m = f.m AND o.k = f.k + 1))"""


def _actions(events: DataFrame) -> DataFrame:
    action = F.when(F.col("event_type") == "purchase", "ack").when(F.col("event_type") == "click", "extend").otherwise("receive")
    return events.select(F.col("user_id").cast("long").alias("message_id"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("at"), action.alias("action"))


@query("x02_leases_and_redelivery", f"WITH RECURSIVE {_FATES} SELECT outcome, count(*) AS n FROM f WHERE outcome IS NOT NULL GROUP BY outcome")
def leases(e) -> DataFrame:
    return _drained(e, tasks.leases(_actions(_events(e))), "leases").groupBy("outcome").agg(F.count("*").alias("n"))


@query("x05_dead_letters", f"WITH RECURSIVE {_FATES} SELECT m AS message_id, count(*) FILTER (outcome = 'delivered') AS receives, count(*) FILTER (outcome = 'dead') AS dead FROM f WHERE outcome IS NOT NULL GROUP BY m")
def dead_letters(e) -> DataFrame:
    """How often each message was received, and how often it came once more after the receives it is allowed and went to the dead letters."""

    def fate(message, rows):
        outcomes = tasks.lease_outcomes(rows)
        return [(message, outcomes.count("delivered"), outcomes.count("dead"))]

    schema = StructType().add("message_id", "long").add("receives", "long").add("dead", "long")
    return per_page(_actions(e.events), "message_id", ["at", "action"], fate, schema)


@query("x12_long_operations", "SELECT user_id, 12 - 4 AS completed, 4 AS failed, user_id % 4 AS pauses FROM (SELECT DISTINCT user_id FROM events)")
def operations(e) -> DataFrame:
    """For each volume (here a user) twelve batches at a service that refuses the first calls for want of quota, never takes each sixth batch and reports an error for another sixth
    and, falsely, for a third. The loop of a volume runs in a task; only volumes at work at the same time share the service."""

    def run(batches):
        for b in batches:
            out = [_operated(u) for u in b.column("user_id").to_pylist()]
            yield pa.RecordBatch.from_pylist([dict(zip(("user_id", "completed", "failed", "pauses"), r)) for r in out], schema=pa.schema([("user_id", pa.int64()), *((c, pa.int64()) for c in ("completed", "failed", "pauses"))]))

    return e.events.select(F.col("user_id").cast("long").alias("user_id")).distinct().mapInArrow(run, "user_id long, completed long, failed long, pauses long")


def _operated(user: int) -> tuple[int, int, int, int]:
    class Quick(tasks.Clock):
        t = 0.0

        def now(self):
            return self.t

        def sleep(self, seconds):
            self.t += seconds

    refused, polls = {"left": user % 4}, {}

    def submit(name):
        if refused["left"]:
            refused["left"] -= 1
            raise tasks.QuotaError
        if int(name) % 6 == 5:
            raise OSError("not taken")

    def check(name):
        polls[name] = polls.get(name, 0) + 1
        if polls[name] == 1:
            raise OSError("no answer")
        return polls[name] > user % 3 + 1, {4: "failed", 3: "written"}.get(int(name) % 6)

    ops, pauses = tasks.run_operations([str(k) for k in range(12)], submit, check, written=lambda error: error == "written", clock=Quick(), in_flight=3)
    done = sum(o.status == "completed" for o in ops)
    return user, done, len(ops) - done, pauses


@query("x13_error_forwarding", """SELECT page_id, CASE WHEN page_id % 5 <> 0 AND page_id % 7 <> 0 THEN length(page_text) * 2 END AS n, CASE WHEN page_id % 5 = 0 THEN 'Decode' WHEN page_id % 7 = 0 THEN 'Recognise' END AS error_stage,
    CASE WHEN page_id % 5 = 0 THEN 'ValueError' WHEN page_id % 7 = 0 THEN 'RuntimeError' END AS error_type, CASE WHEN page_id % 5 = 0 THEN 'bad page ' || page_id WHEN page_id % 7 = 0 THEN 'no text ' || page_id END AS error_message FROM page_output""")
def forwarded(e) -> DataFrame:
    """Pages through two stages: what fails in one passes the next as it is, and the others go on."""
    from ..operators import jobs

    def decode(row):
        if row["page_id"] % 5 == 0:
            raise ValueError(f"bad page {row['page_id']}")
        return {"n": len(row["page_text"])}

    def recognise(row):
        if row["page_id"] % 7 == 0:
            raise RuntimeError(f"no text {row['page_id']}")
        return {"n": row["n"] * 2}

    return jobs.staged(e.page_output.select("page_id", "page_text"), [("Decode", lambda: decode), ("Recognise", lambda: recognise)], "page_id long, n long")


@query("s12_s14_fetched_pages", """SELECT page_id, CASE WHEN page_id % 17 <> 0 AND page_id % 13 <> 0 AND page_id % 11 <> 0 THEN strlen('gs://b/' || file) END AS size, CASE WHEN page_id % 17 = 0 THEN 1 WHEN page_id % 13 = 0 THEN 3 WHEN page_id % 3 = 0 THEN 2 ELSE 1 END AS attempts,
    CASE WHEN page_id % 17 = 0 OR page_id % 13 = 0 THEN 'Fetch' WHEN page_id % 11 = 0 THEN 'Decode' END AS error_stage, CASE WHEN page_id % 17 = 0 THEN 'FileNotFoundError' WHEN page_id % 13 = 0 THEN 'CredentialError' WHEN page_id % 11 = 0 THEN 'ValueError' END AS error_type FROM page_output""")
def fetched_pages(e) -> DataFrame:
    """Pages from a store that lacks some, and turns callers away once for each third page and always for some others; some contents can't be decoded."""
    from ..sources import fetch

    turned: set[str] = set()

    def read(uri: str) -> bytes:
        n = int(uri.rpartition("/p")[2][:8])
        if n % 17 == 0:
            raise FileNotFoundError(uri)
        if n % 13 == 0 or (n % 3 == 0 and uri not in turned):
            turned.add(uri)
            raise fetch.CredentialError(uri)
        return uri.encode()

    def decode(data: bytes) -> bytes:
        if int(data.rpartition(b"/p")[2][:8]) % 11 == 0:
            raise ValueError("not an image")
        return data

    pages = e.page_output.select("page_id", F.concat(F.lit("gs://b/"), "file").alias("uri"))
    return fetch.fetched(pages, read, decode, delay=0.0).select("page_id", F.octet_length("content").alias("size"), "attempts", "error_stage", "error_type")


@query("s07_attached_rows", "SELECT p.page_id, c.label, c.prob FROM page_output p LEFT JOIN classes c USING (page_id)")
def attached(e) -> DataFrame:
    """Pages with rows of another job's artifact, which is written and read again."""
    from ..sources import lists

    path = shared_path(e.spark, "artifact")
    e.classes.write.parquet(path)
    return lists.attached(e.page_output.select("page_id"), lists.read_rows(e.spark, path), "page_id", ["label", "prob"])


@query("s21_telemetry", "SELECT CASE WHEN page_id % 4 = 0 THEN 'p' || page_id ELSE 'own-' || page_id END AS id, page_id % 9 AS fires FROM page_output WHERE page_id % 5 <> 0")
def telemetry(e) -> DataFrame:
    """Records of requests from a folder of small files: a fourth of them without an id of their own, a fifth cut off."""
    from ..sources import lists

    path, p = shared_path(e.spark, "telemetry"), F.col("page_id")
    record = F.to_json(F.struct(F.when(p % 4 != 0, F.concat(F.lit("own-"), p.cast("string"))).alias("id"), (p % 9).alias("fires")))
    files = e.page_output.select(F.concat(F.lit("p"), p.cast("string")).alias("name"), F.when(p % 5 == 0, "{cut").otherwise(record).alias("text"))
    write_texts(files, path)
    return lists.read_telemetry(e.spark, path).select("id", F.get_json_object("record", "$.fires").cast("long").alias("fires"))


@query("p01_p02_model_slot", r"SELECT page_id, greatest(2, len(list_filter(string_split_regex(page_text, '\s+'), lambda x: x <> ''))) AS n FROM page_output")
def model_slot(e) -> DataFrame:
    from ..operators import jobs

    return jobs.run("count_words_v2", e.page_output, {"least": 2}).select("page_id", "n")
